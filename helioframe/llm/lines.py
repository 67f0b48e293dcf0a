"""Line dedup: lines that spread over many sites keep one place, and go everywhere else.

The spread of a line is the number of distinct sites it stands on. HyperLogLog sketches of the sites are
built per line hash inside every task and merged by aggregation, so what is shuffled for a line is a sketch
per task however often the line occurs. A line whose estimate is within ``MARGIN`` of the threshold gets an
exact distinct count. A spread line stays in the document with the least id that has it, all its repeats
there included, and is taken out of every other document; so a text that was copied to many sites is still
whole once.

A line is what stands between line feeds; lines are compared without the white space around them, and lines
of white space alone are never counted or taken out. Defined results: a null text stays null, an empty text
stays empty and a text that loses all its lines becomes empty; no row is dropped, repeated rows are cleaned
alike; a null site counts as one site of its own; lines whose documents all have a null id stay; an empty
table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import free_name, whole_text, written

SITES = 5
MARGIN = 0.25
_LG_K = 10


_BLANKS = " \t\n\x0b\f\r"
_KEY = ["h1", "h2"]


def line_table(docs: DataFrame, site: str = "source") -> DataFrame:
    """doc_id, text_key, site (a hash), pos and the 128 bits h1 and h2 of every line that counts."""
    text, bare = whole_text(), F.col("bare")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit(""))).alias("site"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    rows = rows.withColumn("bare", F.btrim("line", F.lit(_BLANKS))).filter("bare != ''")
    return rows.select("doc_id", "text_key", "site", "pos", F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit(7), bare).alias("h2"))


def spread_lines(lines: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """h1, h2 and first_id of the lines that stand on at least ``sites`` distinct sites."""
    # Lines seen on one site only need no sketch; the two extremes tell them apart in a plain aggregation.
    several = lines.groupBy(*_KEY).agg(F.min("site").alias("a"), F.max("site").alias("b"), F.min("doc_id").alias("first_id"))
    several = written(several.filter("a != b" if sites > 1 else "true").select(*_KEY, "first_id"), "several")
    shared = written(lines.select(*_KEY, "site").join(several.select(*_KEY), _KEY, "left_semi"), "shared")
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", _LG_K))
    counted = shared.groupBy(*_KEY).agg(estimate.alias("sites"))
    counted = written(counted, "estimates")
    near = counted.filter(F.col("sites").between(sites * (1 - margin), sites * (1 + margin))).select(*_KEY)
    exact = shared.join(near, _KEY, "left_semi").distinct().groupBy(*_KEY).count().filter(F.col("count") >= sites)
    sure = counted.filter(F.col("sites") > sites * (1 + margin))
    return written(several.join(sure.select(*_KEY).unionByName(exact.select(*_KEY)), _KEY), "spread")


def removals(lines: DataFrame, spread: DataFrame) -> DataFrame:
    """doc_id, text_key and ``gone``, the positions of the lines that go."""
    out = lines.join(spread, _KEY).filter((F.col("doc_id") != F.col("first_id")) | (F.col("doc_id").isNull() & F.col("first_id").isNotNull()))
    return out.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("gone"))


def clean(docs: DataFrame, sites: int = SITES, site: str = "source", removed: str = "__removed") -> DataFrame:
    """The rows of ``docs`` with all their columns, spread lines taken out of ``text``, and ``removed``, their number."""
    key_name, gone_name = free_name(docs, "__key"), free_name(docs, "__gone")
    lines = line_table(docs, site)
    gone = removals(lines, spread_lines(lines, sites))
    gone = gone.select(F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_key").alias(key_name), F.col("gone").alias(gone_name))
    key = F.struct(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")), F.xxhash64(whole_text()))
    rows = docs.withColumn(key_name, key).join(gone, key_name, "left")
    parts = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone_name))
    text = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    new = F.when(F.col(gone_name).isNotNull(), text).otherwise(F.col("text"))
    columns = [new.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*columns, F.coalesce(F.size(gone_name), F.lit(0)).cast("long").alias(removed))


ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS site FROM documents),
parts AS (SELECT k, doc_id, site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS b FROM parts),
spread AS (SELECT b, min(doc_id) AS first_id FROM bare WHERE b <> '' GROUP BY b HAVING count(DISTINCT site) >= {SITES}),
marked AS (SELECT k, pos, line, first_id IS NOT NULL AND bare.doc_id IS DISTINCT FROM first_id AS gone FROM bare LEFT JOIN spread USING (b)),
cleaned AS (SELECT k, count(*) FILTER (gone) AS removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM marked GROUP BY k)
SELECT doc_id, removed AS n_removed, sha256(cleaned.text) AS cleaned_sha256 FROM docs JOIN cleaned USING (k)"""
