"""Language, periodic runs and ranked search against brute force, and on nulls, empty and long texts, ties and copies."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helioframe.llm import language, queries, ranked, runs

DOCS = "doc_id long, text string, lang string"
ODD = [None, "", " \t", "x", "\n\n", "a b c d e " * 4000, "same text of six words here", "same text of six words here", "é漢😀 \t mixed", "123 !?"]


def table(spark, texts, ids=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, langs or ["en"] * len(texts))), DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, equal rows, null and repeated ids, and columns that clash with helpers' names."""
    docs = table(spark, ODD + ["same text of six words here", "other"], [*range(len(ODD)), None, 3])
    clash = ["score", "rank", "runs", "n", "g", "p", "words", "label", "hash", "letter", "place", "item_id"]
    return docs.select("*", *[F.lit("clash").alias(c) for c in clash])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def plain_runs(words):
    """(start, length, period) of all runs, by trying every period."""
    n, found = len(words), []
    for q in range(1, n // runs.TIMES + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            smallest = not any(all(words[x] == words[x + d] for x in range(i, i + size - d)) for d in range(1, q))
            if j > i and size >= max(runs.LEAST, runs.TIMES * q) and smallest:
                found.append((i, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {x for start, size, q in found for x in range(start + q, start + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found_runs(texts):
    _, listed, collapsed = runs._found([t.encode() for t in texts])
    return [[(r["start"], r["length"], r["period"]) for r in row] for row in listed.to_pylist()], collapsed.to_pylist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aab"), max_size=70), max_size=4))
def test_runs_are_those_of_all_periods(many):
    listed, collapsed = found_runs([" ".join(words) for words in many])
    for words, got, text in zip(many, listed, collapsed):
        assert got == plain_runs(words)
        assert text == plain_collapsed(words, got)


def test_runs_inside_runs_and_in_long_texts():
    inner = ["a"] * 7 + ["b"]
    nested = inner * 5 + ["c"] + ["x", "y", "z"] * 6 + ["x"]
    short, long = "a", "ab"
    for _ in range(14):
        short, long = long, long + short
    listed, _ = found_runs([" ".join(nested), " ".join(long[:600]), "a b c d e " * 40000, "w " * 200000, ""])
    assert listed[0] == plain_runs(nested) and len(listed[0]) == 7
    assert listed[1] == plain_runs(list(long[:600]))
    assert listed[2:] == [[(0, 200000, 5)], [(0, 200000, 1)], []]


def test_places_stay_in_order():
    rng, some = random.Random(3), list(range(0, 30000, 3))
    rng.shuffle(some)
    held = runs.Places(some[0])
    for x in some[1:]:
        held.add(x)
    assert list(held) == sorted(some) and held.size == len(some)
    assert held.around(0) == (None, 3) and held.around(29997) == (29994, None) and held.around(15000) == (14997, 15003)


def test_runs_query_equals_brute_force(spark, tmp_path, odd):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh" if k % 2 else "ab") for _ in range(rng.randrange(120))) for k in range(300)]
    texts += ["x\x0by\x0cz q r \r\n s", "  lead and trail  ", None, ""]
    table(spark, texts, [None if k == 17 else k for k in range(len(texts))]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_runs(spark, str(tmp_path)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = 1 if k == 17 else zlib.crc32(str(k).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        found, row = plain_runs(words), got[None if k == 17 else k]
        assert row["n_runs"] == len(found)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, found).encode()).hexdigest()


def test_runs_on_odd_tables(odd, empty):
    rows = runs.periodic_runs(odd).collect()
    assert len(rows) == len(ODD) + 2
    assert [r["n_words"] for r in rows if r["doc_id"] in (0, 1, 2)] == [0, 0, 0]
    assert next(r for r in rows if r["doc_id"] == 5)["collapsed"] == "a b c d e"
    assert runs.periodic_runs(empty).collect() == []
    assert runs.repeat_tail(odd).count() == len(ODD) + 2


def plain_terms(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def plain_search(docs, items, k=10):
    """Ranked lists by the formula, one pair at a time; docs and items are (id, text)."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    documents, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    union = {}
    for i, t in items:
        union.setdefault(i, set()).update(plain_terms(t))
    out = {}
    for i, wanted in union.items():
        scored = []
        for doc, c in counted:
            n = sum(c.values())
            m = 10 + 90 * n * documents // length if length else 10
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out[i] = [(doc, -s) for s, _, _, doc in sorted(scored, key=lambda x: x[:3])[:k]]
    return out


def search_lists(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (str(r["item_id"]), r["rank"])):
        got.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(got[r["item_id"]])
    return got


def test_search_equals_brute_force_with_ties(spark):
    rng = random.Random(7)
    vocabulary = [f"{a}{b}" for a in "abcdefgé漢" for b in "xyzXYZ09"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 80))) for _ in range(700)]
    texts[100:160] = [texts[99]] * 60  # a tie longer than the list
    ids = rng.sample(range(10000), len(texts))
    items = [(i, rng.choice([" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 30))), texts[99]])) for i in range(150)]
    docs = table(spark, texts, ids).repartition(5)
    got = search_lists(ranked.search(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=2000))
    assert got == plain_search(list(zip(ids, texts)), items)


def test_search_on_odd_tables(spark, odd, empty):
    items = [(1, "same TEXT of"), (2, None), (3, "!!!"), (None, "six"), (1, "漢 é漢😀"), (4, "nowhere"), (5, "a a a b")]
    wanted = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash"))
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    expected = {i: found for i, found in plain_search(rows, items).items() if found}
    assert search_lists(ranked.search(odd, wanted)) == expected
    assert [doc for doc, _ in expected[None]] == [6, 7, None]
    assert ranked.search(empty, wanted).collect() == []
    assert ranked.search(odd, wanted.limit(0)).collect() == []


def test_wide_items_go_in_exact_slices(monkeypatch):
    """Sums beyond 2**53 stay exact, as only slices of the vocabulary are multiplied at once."""
    words = [f"w{k}".encode() for k in range(3000)]
    block = ranked._block({1: set(words), 2: set(words[::7])})
    weight = np.full(len(words), 20_000_001, dtype=np.int64)
    at = np.arange(len(words))
    impact = 999_999 + at % 3
    monkeypatch.setattr(ranked, "TERMS", 64)
    (tile,) = ranked._tiles(block, weight)
    scores = ranked._scores(tile, np.zeros(len(words), dtype=np.int64), at, impact, 2)
    assert scores[:, 0].tolist() == [sum(20_000_001 * int(impact[p]) for p in held) for held in block.held]
    assert scores[0, 0] > 2**53 and scores[:, 1].tolist() == [0, 0]
    assert ranked.TERMS * 10**6 * 1000 * math.log(2 * 10**15) < 2**53


def plain_counts(text):
    folded = re.sub(rb"[^a-z\x80-\xff]", b" ", text.lower().encode())
    data = re.sub(rb" +", b" ", folded)
    out = np.zeros(language.SIZE)
    for n in language.GRAMS:
        for i in range(len(data) - n + 1):
            mixed = int.from_bytes(data[i : i + n], "big") * 0x9E3779B1 + n * 0x85EBCA6B & 0xFFFFFFFF
            out[((mixed ^ mixed >> 15) * 0x9E3779B1 & 0xFFFFFFFF) >> 19] += 1
    return out


def test_counts_are_those_of_each_text_alone(monkeypatch):
    texts = ["Ein Größter, 12 Wort!", "", None, "a", "ab", " é 漢字 ", "No -- digits 99 here"] * 90
    got = np.concatenate([counts for _, _, counts in language.counted(pa.array(texts))])
    assert len(got) == len(texts)
    for text, row in zip(texts, got):
        assert (row == plain_counts(text or "")).all()
    long = " ".join(f"word{k}x" for k in range(4000))
    monkeypatch.setattr(language, "PIECE", 1000)
    ((_, _, counts),) = language.counted(pa.array([long]))
    whole = plain_counts(long)
    # A piece that begins in a run of spaces may hold one space more than the text has there.
    assert np.abs(counts - whole).sum() <= 0.002 * whole.sum()


def test_clusters_find_groups_and_reach():
    rng = np.random.default_rng(1)
    centres = np.eye(8)[:3]
    points = np.abs(np.repeat(centres, 50, axis=0) + rng.normal(0, 0.02, (150, 8)))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    found, reach = language.clusters(points, 3)
    assert sorted((found @ centres.T).argmax(axis=1).tolist()) == [0, 1, 2]
    assert ((found @ centres.T).max(axis=1) > 0.99).all() and (reach < 0.05).all()
    assert len(language.clusters(points[:1], 4)[0]) == 1


SYLLABLES = {"aa": "ka lo mi tu re".split(), "bb": "sch ung pf ein zu".split(), "cc": "ção nho lha om ei".split()}


def speech(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def test_language_of_unseen_texts_and_rejection(spark, odd):
    rng = random.Random(11)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(400)]
    texts = [speech(rng, lang, rng.randrange(5, 60)) for lang in langs]
    docs = table(spark, texts, langs=[None if k % 50 == 0 else lang for k, lang in enumerate(langs)])
    model = language.train(docs, F.col("doc_id") < 300)
    assert model.languages == ["aa", "bb", "cc"] and len(model.centroids) <= 3 * language.CLUSTERS
    rows = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert all(rows[k]["nearest"] == langs[k] and 0 <= rows[k]["score"] <= 1 for k in range(300, 400))
    assert sum(rows[k]["rejected"] for k in range(300, 400)) <= 10
    # A tongue far from all centroids is rejected, and the nearest is still named.
    strange = table(spark, ["ωψχφ ξζθγ βδλκ " * 20, "123 +-", None, ""])
    judged = [(r["language"], r["nearest"] != "und", r["score"] > 0) for r in language.identify(strange, model).orderBy("doc_id").collect()]
    assert judged[0] == ("und", True, judged[0][2]) and judged[1:] == [("und", False, False)] * 3
    assert language.identify(odd, model).count() == len(ODD) + 2


def test_language_learns_neither_from_held_out_labels_nor_other_columns(spark, tmp_path, empty):
    rng = random.Random(13)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(300)]
    texts = [speech(rng, lang, 30) for lang in langs]
    held = [zlib.crc32(str(k).encode()) % 4 == 2 for k in range(300)]
    wrong = ["zz" if out else lang for out, lang in zip(held, langs)]
    table(spark, texts, langs=wrong).withColumn("label", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in queries.op11_language(spark, str(tmp_path)).collect()}
    assert [rows[k]["held_out"] for k in range(300)] == held
    assert [rows[k]["lang_pred"] for k in range(300)] == langs
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op11_language(spark, f"{tmp_path}/none").collect() == []
    unlabelled = language.train(table(spark, texts, langs=[None] * 300).withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert [r["nearest"] for r in language.identify(table(spark, ["a b"]), unlabelled).collect()] == ["und"]
