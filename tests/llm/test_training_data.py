"""The training-data operators against brute force, and on nulls, empty and long texts, ties and copies."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helioframe.llm import decontaminate, fingerprint, lines, neardup, pieces, pseudonyms, queries, secrets, tokenfile, toxicity, urlfilter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = "abcdefghij klmnop qrst uvw xyz lorem ipsum dolor sit amet consectetur adipiscing elit sed do words and identifiers ordinary".split()


def prose(seed: int, n: int, alphabet: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(alphabet)}" for _ in range(n)]


def table(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or ["s0"] * len(texts)
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " ", "x", "\n\n", "a b c d e " * 4000, "same text here with six words", "same text here with six words", "é漢😀 \t mixed"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, equal rows, a null id, and a column that clashes with a helper's name."""
    docs = table(spark, ODD + ["same text here with six words"], [*range(len(ODD)), None])
    return docs.withColumn("score", F.lit("clash")).withColumn("digest", F.lit("clash")).withColumn("hash", F.lit("clash"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


PATTERNS = [
    (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    (re.compile("[0-9a-f]+"), 0, 24),
]


def test_secrets_base_spans_and_random_ones(spark, odd, empty):
    key = "Zx9Qw3Lk7Pv2Rt8Yb4Nm6Hs1"
    texts = ["😀 PassWord = 'hunter22' and AKIA" + "Q7" * 10, "token:abc secret=" + "ab12" * 9, f"ordinary words_and_identifiers {key}", "f" * 24 + "G" + "0" * 23]
    docs = table(spark, texts + ["plain_identifier_name another_ordinary_word " * 5] * 3)
    learnt = [" ".join(f"{random.Random(100 * k + j).choice(VOCAB)}_name_of_{random.Random(k + 7 * j).choice(VOCAB)}" for j in range(30)) for k in range(150)]
    model = secrets.train(secrets.labelled_samples(table(spark, learnt)))
    found = {r["doc_id"]: r for r in secrets.find_secrets(docs, model).collect()}
    for k, text in enumerate(texts):
        wanted = sorted((m.start(), kind, m.end()) for kind, (p, g, n) in enumerate(PATTERNS) for m in p.finditer(text) if len(m.group(g)) >= n)
        assert [(s["start"], s["kind"], s["stop"]) for s in found[k]["spans"] if s["kind"] < 3] == wanted
    assert [s["value"] for s in found[2]["spans"]] == [key]
    assert found[4]["spans"] == []
    assert secrets.find_secrets(odd, model).count() == len(ODD) + 1
    assert secrets.train(secrets.labelled_samples(empty)) == [0.0] * (128 * 128)
    assert secrets.find_secrets(empty, model).count() == 0


def edit_distance(item, text):
    """Least edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_benchmark_matches_equal_brute_force(spark, odd, empty):
    rng, items, texts = random.Random(5), [prose(900 + k, rng_n) for k, rng_n in enumerate([12, 20, 35, 35, 5, 3])], []
    for k in range(120):
        item = list(items[k % len(items)])
        for _ in range(rng.randrange(0, max(2, len(item) // 4 + 2))):
            at = rng.randrange(len(item)) if item else 0
            change = rng.choice(["drop", "swap", "add"])
            if change == "drop" and item:
                del item[at]
            elif change == "swap" and item:
                item[at] = "other"
            else:
                item.insert(at, "added")
        texts.append(" ".join(prose(k, rng.randrange(0, 60)) + item + prose(k + 500, rng.randrange(0, 60))))
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)] + [(99, None), (100, "")], "item_id long, text string")
    known = decontaminate.load_items(benchmark)
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.hits(table(spark, texts), known).collect()}
    wanted = {}
    for d, text in enumerate(texts):
        for k, item in enumerate(items):
            e = edit_distance(item, text.split())
            if e <= len(item) // 5:
                wanted[d, k] = e
    assert set(found) <= set(wanted)
    assert len(found) >= 0.98 * len(wanted)
    assert sum(found[x] == wanted[x] for x in found) >= 0.98 * len(found)
    blocks = decontaminate.load_items(benchmark, most_bytes=150_000)
    assert len(blocks) > 1
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.hits(table(spark, texts), blocks).collect()} == set(found)
    kept = decontaminate.reject_contaminated(table(spark, texts), blocks)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in found}
    assert decontaminate.reject_contaminated(odd, known).columns == odd.columns
    assert decontaminate.reject_contaminated(odd, known).count() == len(ODD) + 1
    assert decontaminate.hits(empty, known).count() == 0
    assert decontaminate.hits(odd, decontaminate.load_items(benchmark.limit(0))).count() == 0


@pytest.mark.parametrize("n", [60, 100, 200, 400])
def test_long_benchmark_items_at_the_edit_limit_are_found(n):
    items, texts = [], []
    for k in range(12):
        item, d = prose(500 + k, n, 10**6), n // 5
        items.append(" ".join(item))
        out = {n * j // d for j in range(d)}
        other = [w for j, w in enumerate(item) if j not in out] if k % 2 else [f"sub{j}" if j in out else w for j, w in enumerate(item)]
        texts.append(" ".join(prose(700 + k, 30, 10**6) + other + prose(800 + k, 30, 10**6)))
    known, found = decontaminate.prepare(list(range(12)), items), set()
    for first, _, flat, begins in decontaminate.words(pa.array(texts, type=pa.large_string())):
        found |= {(first + text, k, edits) for text, k, edits, _ in decontaminate.find(known, flat, begins)}
    assert len(found) == 12 and all(text == k and edits <= n // 5 for text, k, edits in found)


@pytest.mark.parametrize("n", [15, 20, 30, 40, 50, 59, 60, 100, 200])
def test_matches_at_the_edit_limit_reach_the_target(n):
    rng, d = random.Random(n), n // 5
    items, texts = [], []
    for k in range(100):
        item, out = prose(5000 + k, n, 10**6), []
        places = set(rng.sample(range(n), d)) if k % 4 == 3 else {n * j // d for j in range(d)}
        for j, w in enumerate(item):
            change = ["drop", "swap", "add", rng.choice(["drop", "swap", "add"])][k % 4] if j in places else "none"
            out += {"drop": [], "swap": [f"sub{j}"], "add": [f"sub{j}", w], "none": [w]}[change]
        items.append(" ".join(item))
        texts.append(" ".join(prose(7000 + k, 30, 10**6) + out + prose(8000 + k, 30, 10**6)))
    known, found = decontaminate.prepare(list(range(100)), items), set()
    for first, _, flat, begins in decontaminate.words(pa.array(texts, type=pa.large_string())):
        found |= {(first + text, k) for text, k, _, _ in decontaminate.find(known, flat, begins)}
    assert all(text == k for text, k in found) and len(found) >= 97


def test_texts_that_repeat_themselves_cost_their_distinct_windows():
    items = ["word " * 50, "two words " * 25, "word"]
    known, found = decontaminate.prepare([0, 1, 2], items), []
    texts = ["word " * 200_000, "two words " * 100_000, "one two " * 5]
    started = time.monotonic()
    for first, _, flat, begins in decontaminate.words(pa.array(texts, type=pa.large_string())):
        found += [(first + text, *rest) for text, *rest in decontaminate.find(known, flat, begins)]
    assert sorted(found) == [(0, 0, 0, 50), (0, 2, 0, 1), (1, 1, 0, 50)]
    assert time.monotonic() - started < 20


def test_walks_of_close_sequences_agree():
    rng = np.random.default_rng(3)
    a = rng.integers(1, 2**60, size=(200, 40)).astype(np.uint64)
    b = a.copy()
    b[:, 11] += np.uint64(1)
    close = (decontaminate.walk(a, 0) == decontaminate.walk(b, 0)).mean()
    far = (decontaminate.walk(a, 0) == decontaminate.walk(a[::-1].copy(), 0)).mean()
    assert close > 0.6 > 0.2 > far or close - far > 0.4


def test_toxicity_learns_rejects_and_keeps_odd_rows(spark, odd, empty):
    texts = [" ".join(prose(k, 40) + (["vile", "slur"] * 3 if k % 4 == 0 else [])) for k in range(400)]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(200)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(toxicity.training_sample(docs, labels))
    held = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect() if r["doc_id"] >= 200}
    assert np.mean([(s >= 0.7) == (k % 4 == 0) for k, s in held.items()]) > 0.97
    assert toxicity.reject_toxic(odd, model).count() == len(ODD) + 1
    assert toxicity.reject_toxic(odd, model).columns == odd.columns
    assert toxicity.score_documents(empty, model).count() == 0
    none = toxicity.train(toxicity.training_sample(docs, labels.limit(0)))
    assert {r["score"] for r in toxicity.score_documents(odd, none).collect()} == {0.5}


def plain_ftrl(examples, labels, alpha, beta, l1, l2, epochs):
    """Feature by feature: z and n of each, the weight worked out when it is met."""
    z, n, bias = Counter(), Counter(), [0.0, 0.0, 0.0]

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return ((l1 if z[i] > 0 else -l1) - z[i]) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for features, label in zip(examples, labels):
            bias[2] = -bias[0] / ((beta + bias[1] ** 0.5) / alpha)
            held = {int(i): weight(int(i)) for i in features}
            error = 1 / (1 + np.exp(-(bias[2] + sum(held.values())))) - label
            for i, w in held.items():
                rate = ((n[i] + error**2) ** 0.5 - n[i] ** 0.5) / alpha
                z[i] += error - rate * w
                n[i] += error**2
            rate = ((bias[1] + error**2) ** 0.5 - bias[1] ** 0.5) / alpha
            bias[0] += error - rate * bias[2]
            bias[1] += error**2
    return {i: weight(i) for i in z if weight(i)}, bias[2]


@pytest.mark.parametrize("l1", [0.0, 0.7, 6.0])
def test_ftrl_equals_a_plain_one(l1):
    rng = random.Random(5)
    examples = [np.unique([rng.randrange(60) for _ in range(rng.randrange(0, 12))]).astype(np.int64) for _ in range(150)]
    labels = np.array([float(5 in e or rng.random() < 0.2) for e in examples])
    model = toxicity.ftrl(examples, labels, 0.8, 1.0, l1, 0.1, 3)
    weights, bias = plain_ftrl(examples, labels, 0.8, 1.0, l1, 0.1, 3)
    assert model.features.tolist() == sorted(weights) and model.bias == pytest.approx(bias)
    assert model.weights.tolist() == pytest.approx([weights[i] for i in sorted(weights)], rel=1e-5)


def luhn(number: str) -> bool:
    digits = [int(c) for c in reversed(number)]
    return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark, odd, empty):
    cards = ["4111111111111111", "5500005555555559", "4012-8888-8888-1881", "378282246310005"]
    bad = ["4111111111111112", "999.1.1.1", "1999-02-30", "000-12-3456"]
    other = ["2001-09-28", "1970-01-01", "123-45-6789", "10.0.0.255", "+1 (743) 555-3824", "jo.Doe7@mail.example.com"]
    texts = [" ".join(cards + bad + other), "x " + " , ".join(reversed(cards + other)), "no findings 12 34"]
    made = {r["doc_id"]: r for r in pseudonyms.pseudonymize(table(spark, texts), "key").collect()}
    maps = [{f["value"]: f["pseudonym"] for f in made[k]["found"]} for k in (0, 1)]
    assert maps[0] == maps[1] and set(maps[0]) == set(cards + other)
    assert texts[2] == made[2]["text"] and made[2]["found"] == []
    for text in bad:
        assert text in made[0]["text"]
    new = maps[0]
    for card in cards:
        digits = new[card].replace("-", "")
        assert luhn(digits) and len(new[card]) == len(card) and re.sub(r"\d", "9", new[card]) == re.sub(r"\d", "9", card)
    assert all(re.fullmatch(r"(19|20|21)\d\d-\d\d-\d\d", new[d]) for d in other[:2])
    assert all(int(o) < 256 for o in new["10.0.0.255"].split("."))
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[other[4]])
    assert re.fullmatch(r"[a-z]{2}\.[A-Z][a-z]{2}\d@mail\.example\.com", new[other[5]])
    again = pseudonyms.pseudonymize(table(spark, texts[:1]), "another key").first()
    assert {f["value"]: f["pseudonym"] for f in again["found"]} != new
    assert pseudonyms.pseudonymize(odd, "key").count() == len(ODD) + 1
    assert pseudonyms.pseudonymize(empty, "key").count() == 0


def test_permutation_is_one_to_one(spark):
    rows = spark.range(1000).select(F.array(F.floor(F.col("id") / 100) % 10, F.floor(F.col("id") / 10) % 10, F.col("id") % 10).alias("v"))
    tens = F.transform("v", lambda d: F.lit(10).cast("bigint"))
    found = [tuple(r[0]) for r in rows.select(pseudonyms.permute(F.col("v"), tens, "test", "key")).collect()]
    assert len(set(found)) == 1000 and all(0 <= x < 10 for f in found for x in f)


def plain_feistel(values, radices, kind, key):
    half = len(values) // 2
    for turn in range(pseudonyms.ROUNDS):
        left, right = values[:half], values[half:]
        given = right if turn % 2 == 0 else left
        said = "|".join([key, kind, ",".join(map(str, radices)), str(turn), ",".join(map(str, given))])
        shift = [int(hashlib.sha256(f"{said}|{i}".encode()).hexdigest()[:12], 16) for i in range(len(values))]
        added = [(v + s) % r for v, s, r in zip(values, shift, radices)]
        values = added[:half] + right if turn % 2 == 0 else left + added[half:]
    return values


def test_permutation_equals_a_plain_feistel_network(spark):
    rng = random.Random(8)
    given = []
    for n in [1, 2, 3, 4, 7, 15, 18] * 6:
        radices = [rng.choice([1, 2, 10, 26, 256, 9999]) for _ in range(n)]
        given.append(([rng.randrange(r) for r in radices], radices))
    rows = spark.createDataFrame(given, "v array<bigint>, r array<bigint>")
    found = rows.select("v", "r", pseudonyms.permute(F.col("v"), F.col("r"), "kind", "key").alias("new")).collect()
    assert len(found) == len(given)
    for row in found:
        assert row["new"] == plain_feistel(row["v"], row["r"], "kind", "key")
    ip, phone = "10.0.0.255", "(743) 555-3824"
    made = pseudonyms.pseudonymize(table(spark, [f"{ip} {phone}"]), "key").first()["text"]
    octets = plain_feistel([10, 0, 0, 255], [256] * 4, "ip", "key")
    digits = "".join(map(str, plain_feistel([int(c) for c in phone if c.isdigit()], [10] * 10, "phone", "key")))
    assert made == ".".join(map(str, octets)) + f" ({digits[:3]}) {digits[3:6]}-{digits[6:]}"


def counts(text):
    words = re.findall(r"[^\W]+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def brute_classes(texts):
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [counts(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            common = sum((sets[i] & sets[j]).values())
            union = sum(sets[i].values()) + sum(sets[j].values()) - common
            if (texts[i] or "") == (texts[j] or "") or (union and common / union >= 0.8):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


def test_near_duplicates_equal_brute_force(spark, odd, empty):
    rng, texts = random.Random(8), []
    for group in range(12):
        base = prose(group, rng.randrange(30, 200))
        for _ in range(rng.randrange(1, 14)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += [None, "", "one two", "one two", "...", "lorem ipsum " * 300]
    docs = table(spark, texts)
    labelled = neardup.classes(docs)
    found = {r["doc_id"]: r["class_id"] for r in labelled.collect()}
    assert [found[i] for i in range(len(texts))] == brute_classes(texts)
    assert {r["doc_id"] for r in neardup.one_of_each(docs).collect()} == set(brute_classes(texts))
    kept = neardup.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4, 5, 6, 8]
    assert neardup.classes(empty).count() == 0 and neardup.one_of_each(empty).count() == 0


def test_near_duplicates_of_a_template_equal_brute_force(spark):
    """Texts of one template, of similarity 0.78, fill the buckets; pairs of 0.81 lie among them."""
    texts, common = [], prose(77, 180)
    for k in range(300):
        texts.append(" ".join(common + [f"own{k}x{j}" for j in range(25)]))
    for k in range(0, 300, 4):
        texts.append(" ".join(texts[k].split()[:184] + [f"new{k}x{j}" for j in range(21)]))
    found = {r["doc_id"]: r["class_id"] for r in neardup.classes(table(spark, texts)).collect()}
    wanted = brute_classes(texts)
    assert len(set(wanted)) == 300
    assert sum(found[i] != wanted[i] for i in range(len(texts))) == 0


def test_near_duplicates_with_null_and_repeated_ids(spark):
    unlike = [" ".join(prose(900 + k, 40)) for k in range(8)]
    near = unlike[7] + " end"
    docs = table(spark, [*unlike, near, unlike[0]], [None, None, None, 7, 7, 7, 8, 7, 9, None])
    kept = sorted((r["text"], r["doc_id"]) for r in neardup.one_of_each(docs).collect())
    assert len(kept) == 8
    assert kept == sorted(zip(unlike, [None, None, None, 7, 7, 7, 8, 7]))
    labelled = neardup.classes(docs).collect()
    assert len(labelled) == 10 and len({r["class_digest"] for r in labelled}) == 8
    assert len({r["class_digest"] for r in labelled if r["class_id"] == 7}) == 4


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    shared, left, right = (rng.integers(0, 2**63, size=n).astype(np.uint64) for n in (300, 100, 100))
    a, b = (neardup.signature(neardup.strips(*neardup.weights(np.concatenate([shared, shared, x])))) for x in (left, right))
    assert abs((a == b).mean() - 600 / 800) < 0.12
    assert len(neardup.signature(neardup.strips(*neardup.weights(shared[:1])))) == neardup.SIZE


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("h", f"h{i}") for i in range(50)]
    found = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert all(found[f"{i:03}"] == "000" for i in range(1, 61)) and all(found[f"h{i}"] == "h" for i in range(50))


def test_token_files_round_trip(spark, odd, empty, folder):
    from tokenizers import Tokenizer

    path = queries.byte_vocabulary()
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab e'st th\n\t0é漢😀-_=#  ") for _ in range(rng.randrange(80))) for _ in range(300)] + ["a <|endoftext|> b"]
    docs = table(spark, texts).repartition(7)
    tokenfile.write_tokens(docs, path, f"{folder}/t")
    tokens = tokenfile.read_tokens(spark, f"{folder}/t")
    found = {r["doc_id"]: r for r in tokenfile.digests(tokens).collect()}
    library, start = Tokenizer.from_file(path), 0
    for k, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert tuple(found[k])[1:] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    plan = tokens.filter("doc_id = 5").select("n_tokens")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,5)" in plan and "tokens:array" not in plan.split("ReadSchema")[-1]
    tokenfile.write_tokens(odd, path, f"{folder}/odd")
    assert tokenfile.digests(tokenfile.read_tokens(spark, f"{folder}/odd")).count() == len(ODD) + 1
    tokenfile.write_tokens(empty, path, f"{folder}/none")
    assert tokenfile.digests(tokenfile.read_tokens(spark, f"{folder}/none")).count() == 0


class _Asked:
    """The library, with a count of the texts it is asked for."""

    def __init__(self, library):
        self.library, self.texts = library, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.library.encode_batch_fast(texts, **more)


def test_token_encoder_asks_for_new_words_together_and_for_known_ones_never():
    known = tokenfile.Encoder(queries.byte_vocabulary())
    library = known.library
    known.library = asked = _Asked(library)
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdéefghij") for _ in range(rng.randrange(3, 12))) for _ in range(2000)})
    assert len(words) > 1000
    plain = "." + "".join(f" {w}" for w in words)
    ended = "." + "".join(f" {w}{e}" for w, e in zip(words, itertools.cycle([",", ".", "!", "\n", "'s", "7"])))
    for text, most in ((plain, 10), (ended, 20), (ended + plain[1:], 0)):
        asked.texts = 0
        assert known.encode(pa.array([text]), 0).to_pylist() == [library.encode(text, add_special_tokens=False).ids + [0]]
        assert asked.texts <= most


@pytest.mark.parametrize("case", ["usual", "small cache", "small blocks", "tokens of unknown size", "texts whole"])
def test_token_encoder_equals_the_library(monkeypatch, case):
    known = tokenfile.Encoder(queries.byte_vocabulary())
    if case == "small cache":
        monkeypatch.setattr(tokenfile, "CACHE_WORDS", 50)
    if case == "small blocks":
        monkeypatch.setattr(tokenfile, "JOINED", 30)
    if case == "tokens of unknown size":
        known.bytes[::2] = 0
    known.cuts = case != "texts whole"
    rng = random.Random(7)
    signs = "ab e'sreth\n\r\t\0009é漢😀-_=#.,(  \x1c\x85\xa0\u2003\u2028\u200b\u3000çЖ×÷ªµ\u0300ǅʰ“”"
    odd = ["", "a", "é", " ", "  ", "a ", " a", "\n\n a", "x" * 200 + "," + "é" * 200, "a <|endoftext|> b", " <|endoftext|>", "a  <|endoftext|>  b c"]
    blocks = [[t] for t in odd] + [odd, ["", ""]]
    blocks += [["".join(rng.choice(signs) for _ in range(rng.randrange(n))) for _ in range(200)] for n in (3, 10, 60, 60)]
    for texts in blocks:
        wanted = [known.library.encode(t, add_special_tokens=False).ids + [9] for t in texts]
        assert known.encode(pa.array(["before", *texts, "after"]).slice(1, len(texts)), 9).to_pylist() == wanted


def test_pieces_equal_the_library(spark, odd, empty):
    import sentencepiece

    path = queries.piece_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab e rthn  ▁\n\t0é漢😀-_=#") for _ in range(rng.randrange(80))) for _ in range(500)]
    texts += [" " * n for n in range(40)] + ["=-" * 200, "<0x0A></s> <s>"]
    found = {r["doc_id"]: r for r in pieces.decode(pieces.encode(table(spark, texts), path), path).collect()}
    for k, text in enumerate(texts):
        ids = library.encode(text or "") + [library.eos_id()]
        assert found[k]["ids"] == ids and found[k]["decoded"] == library.decode(ids)
    assert pieces.encode(odd, path).count() == len(ODD) + 1
    assert pieces.digests(pieces.decode(pieces.encode(empty, path), path)).count() == 0


def test_long_runs_take_one_round():
    import sentencepiece

    path = queries.piece_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    vocab = pieces.vocabulary(path)
    rng = random.Random(9)
    texts = [" " * n for n in (41, 63, 64, 65, 1000, 4099)] + ["x" + " " * 333 + "y", "=" * 999, "\n" * 500, "▁ " * 300]
    texts += ["".join(rng.choice([" " * rng.randrange(1, 40), "a", "the", "▁", "\t", "é", "=="]) for _ in range(60)) for _ in range(300)]
    for text, ids in zip(texts, vocab.encode(texts)):
        assert np.frombuffer(ids, dtype=np.int32).tolist() == library.encode(text)
    started = time.time()
    found = vocab.encode([" " * 100_000 + "end"])[0]
    assert time.time() - started < 1
    assert np.frombuffer(found, dtype=np.int32).tolist() == library.encode(" " * 100_000 + "end")


def brute_lines(rows, sites):
    seen = {}
    for doc, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip():
                entry = seen.setdefault(line.strip(), (set(), []))
                entry[0].add(site)
                entry[1].append(doc)
    out = {}
    for doc, text, site in rows:
        gone = lambda line: line.strip() and len(seen[line.strip()][0]) >= sites and min(seen[line.strip()][1]) != doc
        out[doc] = None if text is None else "\n".join(line for line in text.split("\n") if not gone(line))
    return out


@pytest.mark.parametrize("sites", [2, 5, 40])
def test_line_dedup_equals_brute_force(spark, sites):
    rng, rows = random.Random(sites), []
    for doc in range(400):
        body = [rng.choice(["Share this page", " Share this page ", "", "   ", f"own {doc}", f"group {doc % 7}", f"wide {doc % 2}"]) for _ in range(rng.randrange(0, 9))]
        rows.append((doc, "\n".join(body) if doc % 50 else None, f"s{rng.randrange(60)}" if rng.random() < 0.6 else "s0"))
    docs = table(spark, [r[1] for r in rows], sources=[r[2] for r in rows])
    found = {r["doc_id"]: r["text"] for r in lines.clean(docs, sites).collect()}
    assert found == brute_lines(rows, sites)


def test_line_dedup_of_odd_rows(odd, empty):
    cleaned = lines.clean(odd, 1)
    assert cleaned.columns == [*odd.columns, "__removed"] and cleaned.count() == len(ODD) + 1
    found = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert found[0] is None and found[6] == ODD[6] and found[7] == "" and found[None] == ""
    assert lines.clean(empty).count() == 0


def test_columns_named_like_helpers_stay(spark):
    docs = table(spark, [f"shared line\nown {k}" for k in range(6)] + ["own 1"], sources=[f"s{k}" for k in range(7)])
    for name in ("__key", "__gone", "__kept", "__removed", "__KEY_"):
        docs = docs.withColumn(name, F.concat(F.lit(name), "doc_id"))
    wanted = {k: "shared line\nown 0" if k == 0 else f"own {k}" for k in range(6)} | {6: "own 1"}
    cleaned = corpus_pipeline.line_stage(spark, docs, "")
    kept = neardup.one_of_each(cleaned)
    assert cleaned.columns == kept.columns == docs.columns
    for df, ids in ((cleaned, range(7)), (kept, range(6))):
        found = {r["doc_id"]: r for r in df.collect()}
        assert {k: r["text"] for k, r in found.items()} == {k: wanted[k] for k in ids}
        assert all(r[c] == f"{c}{k}" for k, r in found.items() for c in docs.columns[5:])


def test_fingerprints_of_edited_and_next_texts(spark, odd, empty):
    texts = [" ".join(prose(k % 9, 20 + k)) for k in range(60)] + [None, "", "short"]
    found = {r["doc_id"]: r for r in fingerprint.fingerprints(table(spark, texts).repartition(5)).collect()}
    order = sorted(range(len(texts)), reverse=True)
    prints = {}
    for place, k in enumerate(order):
        text, following = texts[k] or "", texts[order[(place + 1) % len(order)]] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert found[k]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert found[k]["n_chars"] == len(text) and 0 <= found[k]["near_edited"] <= 1
        same = next((i for i, (a, b) in enumerate(zip(text, following)) if a != b), min(len(text), len(following)))
        assert found[k]["same_start"] == same
        prints.setdefault(text, set()).add(found[k]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set().union(*prints.values())) == len(prints)
    assert fingerprint.fingerprints(odd).count() == len(ODD) + 1
    assert fingerprint.fingerprints(empty).count() == 0
    one = fingerprint.fingerprints(table(spark, ["alone in here"])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_likeness_is_that_of_the_least_span_hashes(spark):
    """Both likeness columns against spans hashed one by one."""
    texts = [" ".join(prose(k // 3, 30 + k % 3)) for k in range(30)] + ["", "short", "x" * 200, "y" * 23]
    found = {r["doc_id"]: r for r in fingerprint.fingerprints(table(spark, texts)).collect()}

    def least(text):
        codes, hashes = [ord(c) for c in text], set()
        size = min(fingerprint.SPAN, len(codes))
        for i in range(max(len(codes) - fingerprint.SPAN + 1, min(len(codes), 1))):
            both = size
            for p, base in zip(fingerprint.PRIMES, fingerprint.BASES):
                both = both * 2**31 + sum((c + 1) * pow(base, j, p) for j, c in enumerate(codes[i : i + size])) % p
            hashes.add(int(fingerprint.mix(np.array([both % 2**64], dtype=np.uint64))[0]))
        return sorted(hashes)[: fingerprint.KEPT]

    def likeness(a, b):
        both = sorted({*a, *b})[: fingerprint.KEPT]
        return sum(h in a and h in b for h in both) / len(both) if both else 1.0

    order = sorted(range(len(texts)), reverse=True)
    for place, k in enumerate(order):
        text, following = texts[k], texts[order[(place + 1) % len(order)]]
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert found[k]["near_edited"] == likeness(least(text), least(changed))
        assert found[k]["near_next"] == likeness(least(text), least(following))


def test_ranges_of_ids_keep_the_order(spark):
    rng = random.Random(9)
    ids = [rng.randrange(50) for _ in range(500)] + [7] * 700 + [-(2**63), 2**63 - 1]
    places = [rng.randrange(-(2**63), 2**63) for _ in ids]
    bounds = sorted(sorted(ids)[k * len(ids) // 40] for k in range(1, 40))
    got = fingerprint.range_of(np.array(ids), np.zeros(len(ids), bool), np.array(places), fingerprint.id_ranges(bounds))
    rows = sorted(zip(ids, places, got.tolist()), key=lambda r: (-r[0], r[1]))
    assert [r[2] for r in rows] == sorted(got.tolist())
    assert max(Counter(got.tolist()).values()) < 100
    assert fingerprint.range_of(np.array([1]), np.array([False]), np.array([1]), fingerprint.id_ranges([])).tolist() == [0]
    # A hot id, null ids and repeated rows, each with the row after it.
    texts = [f"text {k % 300} of many" for k in range(900)]
    docs = table(spark, texts, [5 if k % 2 else None if k % 10 == 0 else k for k in range(900)])
    found = fingerprint.fingerprints(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    assert sum(r["near_next"] == 1.0 for r in found) >= 150


def test_prefix_hashes_answer_spans():
    rng = random.Random(6)
    text = "".join(rng.choice("ab") for _ in range(400)) * 2
    hashes = fingerprint.PrefixHash(fingerprint.code_points(text))
    for _ in range(300):
        i, j, n = rng.randrange(800), rng.randrange(800), rng.randrange(60)
        if max(i, j) + n <= 800:
            assert hashes.same(i, hashes, j, n) == (text[i : i + n] == text[j : j + n])
    assert hashes.extension(0, hashes, 400) == 400


def test_urls_rules_hosts_and_reputation(spark, empty):
    urls = ["https://A.Example.NET/en/x?y#z", "http://example.net?/en/", "x", None, "ftp://b.org/fr/1", "://c.example.com/de/", "http://notexample.net/en/"]
    urls += [f"http://bad.site/{k}" for k in range(30)] + [f"http://good.site2/{k}" for k in range(30)] + ["http://fresh.bad.site/1"]
    pages = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)], "page_id long, url string, html string")
    outcomes = spark.createDataFrame([(k, int("bad" in (u or ""))) for k, u in enumerate(urls) if k < 67] + [(None, 1)], "page_id long, bad int")
    judged = {r["page_id"]: r for r in urlfilter.judge(pages, outcomes, queries.RULES).collect()}
    assert [(judged[k]["host"], judged[k]["path"]) for k in range(6)] == [
        ("a.example.net", "/en/x"), ("example.net", ""), ("", ""), ("", ""), ("b.org", "/fr/1"), ("c.example.com", "/de/"),
    ]
    assert [judged[k]["rule"] for k in range(7)] == ["example.net/en/", None, None, None, "org/fr/", "example.com/de/", "net/"]
    assert judged[10]["verdict"] == "block" and judged[40]["verdict"] == "allow" and judged[67]["verdict"] == "block"
    assert urlfilter.judge(pages.limit(0), outcomes, queries.RULES).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(pages.filter("page_id > 6"), outcomes.limit(0), queries.RULES).collect()} == {"allow"}


def test_pipeline_stages_take_effect(spark, folder):
    passage = " ".join(prose(77, 30))
    texts = [" ".join(prose(k, 60)) for k in range(40)]
    texts += [texts[3], texts[4] + " tail", "before " + passage + " after", None, "", " ".join(prose(50, 30) + ["vile", "slur"] * 4)]
    texts += [" ".join(prose(100 + k, 40) + (["vile", "slur"] * 3 if k % 3 == 0 else [])) for k in range(150)]
    table(spark, texts).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1, int("vile" in (t or ""))) for k, t in enumerate(texts) if k > 45]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(range(40)) <= set(rows) and not {40, 41, 42, 44, 45} & set(rows) and 43 in rows
    assert rows[43]["ids"] == [2] and rows[5]["n_tokens"] == len(rows[5]["ids"])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_pipeline_on_odd_rows(spark, folder):
    """Null and repeated ids of unlike texts, null, empty and long texts, and columns named like helpers, through all stages."""
    import sentencepiece

    clean = [" ".join(prose(500 + k, 40)) for k in range(12)]
    rows = [(None, t) for t in clean[:4]] + [(7, t) for t in clean[4:7]] + [(k + 20, t) for k, t in enumerate(clean[7:])]
    rows += [(None, clean[0]), (7, clean[4]), (7, clean[4]), (40, None), (41, ""), (None, None)]
    rows += [(42, "a b c d e " * 20_000), (43, " " * 50_000 + "end"), (44, "é漢😀 \t mixed")]
    docs = table(spark, [t for _, t in rows], [i for i, _ in rows])
    for name in ("score", "digest", "hash", "__key", "__gone", "__kept", "__removed", "bucket", "label", "ids"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, " ".join(prose(9, 30))), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stage_input = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, stage_input, folder).columns == docs.columns
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    found = Counter(tuple(r["ids"]) for r in corpus_pipeline.run(spark, folder).collect())
    assert found == Counter(tuple(library.encode(t) + [library.eos_id()]) for t in {t or "" for _, t in rows})
