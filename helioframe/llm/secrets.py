"""Secret scan: three fixed patterns, and a character Markov model for strings that no pattern names.

Two first-order Markov models, one of random strings and one of ordinary identifiers, are counted from
labelled samples. A token of the text belongs to the secrets when the log-likelihood ratio of its character
pairs exceeds a margin and it does not touch a span of the fixed patterns. Everything on the path is a
DataFrame function; the model is a table of 128 x 128 numbers, whatever the corpus holds.

Positions: a pattern's matches and the pieces between them add up to the text, so the prefix sums of their
lengths give each match's place in code points.

Defined results: a null text counts as empty and has no spans; repeated rows are scanned each; spans that
start together come in the order assign, access, hex, random; an empty table gives an empty result; with no
rows to learn from, all ratios are zero and only the fixed patterns find spans; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import numbered_text

# The patterns of the three base kinds and the least length of a finding.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ["assign", "access", "hex", "random"]

# A maximal run keeps its start when its least length is part of the pattern, so these find the same spans.
_ACCESS_LONG = r"AKIA[A-Z0-9]{16,}"
_HEX_LONG = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=.-]{16,}"
_LEARNT_TOKEN = r"[A-Za-z0-9+/_=.-]{4,}"
#: Log-likelihood ratio (nats) above which a token counts as random.
MARGIN = 10.0
#: At most this many texts are learnt from: the documented bound of the sample.
SAMPLE_TEXTS = 2000
_SMOOTHING = 0.5
_BLOCK = 256


def _prefix_sums(steps: Column) -> Column:
    """For each element of an array of numbers the sum of those before it, in blocks so that cost stays near linear."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    inner = F.transform(
        blocks,
        lambda block: F.aggregate(
            block, F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x)
        ),
    )
    start = F.struct(F.lit(0).cast("long").alias("base"), F.lit([]).cast("array<array<bigint>>").alias("out"))
    return F.aggregate(
        inner,
        start,
        lambda acc, sums: F.struct(
            (acc["base"] + F.element_at(sums, -1)).alias("base"),
            F.array_append(
                acc["out"], F.transform(F.slice(sums, F.lit(1), F.size(sums) - 1), lambda v: v + acc["base"])
            ).alias("out"),
        ),
        lambda acc: F.flatten(acc["out"]),
    )


_SPANS = "array<struct<start:bigint,kind:int,stop:bigint,value:string>>"


def _matches(df: DataFrame, kind: int, pattern: str, value_group: int = 0) -> DataFrame:
    """Adds ``spans_<kind>``: start, kind, stop and value of each match of the pattern in ``text``."""
    name = f"spans_{kind}"
    found, pieces, steps = f"_found_{kind}", f"_pieces_{kind}", f"_steps_{kind}"
    df = df.withColumn(found, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn(pieces, F.when(F.size(found) > 0, F.split("text", pattern, -1)))
    values = F.regexp_extract_all("text", F.lit(pattern), F.lit(value_group)) if value_group else F.col(found)
    both = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(found)),
        found,
        lambda gap, match: F.struct(F.char_length(gap).cast("long").alias("gap"), F.char_length(match).cast("long").alias("match")),
    )
    df = df.withColumn(steps, F.when(F.size(found) > 0, both))
    before = _prefix_sums(F.transform(steps, lambda s: s["gap"] + s["match"]))
    placed = F.zip_with(
        F.zip_with(steps, before, lambda s, b: F.struct((b + s["gap"]).alias("start"), (b + s["gap"] + s["match"]).alias("stop"))),
        values,
        lambda s, v: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["stop"].alias("stop"), v.alias("value")),
    )
    empty = F.lit([]).cast(_SPANS)
    df = df.withColumn(name, F.when(F.size(found) > 0, placed.cast(_SPANS)).otherwise(empty))
    return df.drop(found, pieces, steps)


def base_spans(texts: DataFrame) -> DataFrame:
    """Adds spans_0 (assign), spans_1 (access) and spans_2 (hex) to rows with a ``text``."""
    df = _matches(texts, 0, ASSIGN, value_group=2)
    df = df.withColumn("spans_0", F.filter("spans_0", lambda s: F.char_length(s["value"]) >= ASSIGN_LEAST))
    return _matches(_matches(df, 1, _ACCESS_LONG), 2, _HEX_LONG)


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), F.ascii)


def labelled_samples(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """token and label (1 random, 0 ordinary) from at most ``texts`` documents, chosen by a hash of the id.

    Random are the values of the base findings, and digests of the texts in the two alphabets that keys are
    written in; ordinary are the other tokens of the same texts.
    """
    rows, place = numbered_text(docs), F.xxhash64(F.lit(29), "doc_id")
    # Ids are chosen first, so that no more texts than the sample's are sorted; at most ``texts`` ids are sent to the tasks.
    ids = rows.groupBy("doc_id").agg(F.lit(1).alias("one")).orderBy(place, "doc_id").limit(texts)
    chosen = rows.join(F.broadcast(ids.select(F.col("doc_id").alias("chosen"))), F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi")
    sample = chosen.orderBy(place, "doc_id", "text").limit(texts)
    found = base_spans(sample)
    digests = F.array(
        F.sha2("text", 256),
        F.base64(F.unhex(F.sha2("text", 512))),
        F.base64(F.unhex(F.sha2(F.concat("text", F.lit("+")), 512))),
        F.upper(F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat("text", F.lit("-")), 512))), "[+/=]", "")),
    )
    values = F.transform(F.concat("spans_0", "spans_1", "spans_2"), lambda s: s["value"])
    plain = F.col("text")
    for pattern in (ASSIGN, _ACCESS_LONG, _HEX_LONG):
        plain = F.regexp_replace(plain, pattern, " ")
    ordinary = F.regexp_extract_all(plain, F.lit(_LEARNT_TOKEN), F.lit(0))
    random = found.select(F.explode(F.concat(values, digests)).alias("token"), F.lit(1).alias("label"))
    return random.unionByName(found.select(F.explode(ordinary).alias("token"), F.lit(0).alias("label")))


def train(samples: DataFrame) -> list[float]:
    """Log ratio of the two models' transition probabilities, at ``128 * first + second`` of the character codes."""
    codes = samples.select("label", _codes(F.col("token")).alias("codes"))
    length = F.size("codes")
    pairs = F.zip_with(
        F.slice("codes", F.lit(1), length - 1),
        F.slice("codes", F.lit(2), length - 1),
        lambda a, b: a * 128 + b,
    )
    counted = codes.filter(length > 1).select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").count()
    counts = [[0.0] * (128 * 128) for _ in range(2)]
    for row in counted.collect():  # at most two tables of 128 x 128
        if 0 <= row["pair"] < 128 * 128:
            counts[row["label"]][row["pair"]] = float(row["count"])
    if not any(counts[0]) or not any(counts[1]):
        return [0.0] * (128 * 128)
    alphabet = [ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"]
    ratio = [0.0] * (128 * 128)
    for a in alphabet:
        rows = [sum(counts[label][128 * a + b] for b in alphabet) + _SMOOTHING * len(alphabet) for label in (0, 1)]
        for b in alphabet:
            at = 128 * a + b
            ratio[at] = math.log((counts[1][at] + _SMOOTHING) / rows[1]) - math.log((counts[0][at] + _SMOOTHING) / rows[0])
    return ratio


def log_ratio(token: Column, ratio: list[float]) -> Column:
    """Sum of the model's log ratios over the character pairs of an ASCII token."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in ratio)), ",").cast("array<double>")
    n = F.char_length(token) - 1
    pairs = F.zip_with(
        F.slice(_codes(token), F.lit(1), n), F.slice(_codes(token), F.lit(2), n), lambda a, b: F.element_at(table, a * 128 + b + 1)
    )
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def find_secrets(docs: DataFrame, ratio: list[float], margin: float = MARGIN) -> DataFrame:
    """doc_id, text, and ``spans``: kind (place in ``KINDS``), start, stop and value, by start and then kind."""
    df = base_spans(numbered_text(docs))
    base = F.concat("spans_0", "spans_1", "spans_2")
    df = df.withColumn("base", base)
    df = _matches(df, 3, TOKEN)
    df = df.withColumn("spans_3", F.filter("spans_3", lambda s: log_ratio(s["value"], ratio) > margin))
    apart = F.filter(
        "spans_3", lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    )
    return df.select("doc_id", "text", F.array_sort(F.concat("base", apart)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])
    return F.array_join(F.transform(spans, one), ",")
