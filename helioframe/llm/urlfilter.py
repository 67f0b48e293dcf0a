"""URL filter: fixed rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes (1: bad) are counted per host. A beta-binomial prior passes down from the whole
table to the suffix, the registered domain and the host: each level's rate is shrunk towards its parent's
by a strength that the spread among the children gives (moment estimate of the beta-binomial's
correlation). A page is blocked when the lower posterior bound of its host's bad rate is above a limit, so
hosts with few labels are judged by their domain, and those without any by what lies above.

The registered domain is the last two labels of a host and the suffix its last label. Only DataFrame
functions are used; what comes to the driver are a handful of sums.

Defined results: a null url, or one without ``://``, has an empty host and path; an empty host is a host
like any other; a page without labels adds none; of several labels of a page the largest counts; repeated
pages are judged each; with no labels at all every rate is a half and nothing is blocked; extra columns of
the pages are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LIMIT = 0.5
Z = 1.645
#: Correlation among children where the labels cannot tell, and its bounds.
RHO_DEFAULT, RHO_LEAST, RHO_MOST = 0.1, 0.001, 0.5


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host up to the first ``/``, ``?`` or ``#`` after the first ``://``, and the path up to ``?`` or ``#``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = rest
    for mark in "/?#":
        host = F.substring_index(host, mark, 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    for mark in "?#":
        path = F.substring_index(path, mark, 1)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls; of equally long ones the first by name."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _shrunk(children: DataFrame, mean: str, strength: float) -> Column:
    return (F.col("bad") + strength * F.col(mean)) / (F.col("seen") + strength)


def _strength(children: DataFrame, mean: str) -> float:
    """Prior strength from how far the children's rates lie from their parents' beyond chance."""
    spread = F.col(mean) * (1 - F.col(mean))
    rate = F.col("bad") / F.col("seen")
    sums = (
        children.filter(F.col("seen") > 0)
        .agg(
            F.sum(F.col("seen") * (rate - F.col(mean)) ** 2).alias("found"),
            F.sum(spread).alias("chance"),
            F.sum(spread * (F.col("seen") - 1)).alias("more"),
        )
        .first()
    )
    if not sums["more"]:
        rho = RHO_DEFAULT
    else:
        rho = min(max((sums["found"] - sums["chance"]) / sums["more"], RHO_LEAST), RHO_MOST)
    return 1 / rho - 1


def _summed(hosts: DataFrame, by: list[str]) -> DataFrame:
    return hosts.groupBy(*by).agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, seen, bad, rate and bound of every host of ``pages(page_id, host)``; ``outcomes(page_id, bad)``."""
    marks = outcomes.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    hosts = pages.join(marks, "page_id", "left").groupBy("host")
    hosts = hosts.agg(F.count("bad").alias("seen"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = hosts.withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))
    hosts = written(hosts, "hosts")
    total = hosts.agg(F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    suffixes = _summed(hosts, ["suffix"]).withColumn("mean", F.lit((total[1] + 0.5) / (total[0] + 1)))
    suffixes = suffixes.select("suffix", _shrunk(suffixes, "mean", _strength(suffixes, "mean")).alias("suffix_rate"))
    domains = _summed(hosts, ["suffix", "domain"]).join(suffixes, "suffix")
    domains = domains.select("domain", _shrunk(domains, "suffix_rate", _strength(domains, "suffix_rate")).alias("domain_rate"))
    hosts = hosts.join(domains, "domain")
    strength = _strength(hosts, "domain_rate")
    rate = _shrunk(hosts, "domain_rate", strength)
    hosts = hosts.select("host", "seen", "bad", rate.alias("rate"))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("seen") + strength + 1))
    return hosts.withColumn("bound", F.col("rate") - Z * spread)


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``outcomes(page_id, bad)`` are labelled pages."""
    host, path = host_and_path(F.col("url"))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    reputation = host_reputation(pages.select("page_id", "host"), outcomes).select("host", "bound")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    blocked = F.when(F.col("bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    judged = pages.join(reputation, "host", "left")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, blocked).alias("verdict"))


def oracle_sql(rules: list[Rule], limit: float = LIMIT) -> str:
    """The same judgement in DuckDB SQL over ``pages`` and ``labels``, bad where quality is 0."""
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{{r.verdict}:{r.text}}}"
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    )
    names, verdicts = cases, cases
    for r in rules:
        names = names.replace(f"{{{r.verdict}:{r.text}}}", f"'{r.text}'")
        verdicts = verdicts.replace(f"{{{r.verdict}:{r.text}}}", f"'{r.verdict}'")

    def rho(table: str, mean: str) -> str:
        return (
            f"(SELECT CASE WHEN coalesce(sum({mean} * (1 - {mean}) * (seen - 1)), 0) = 0 THEN {RHO_DEFAULT} ELSE "
            f"least(greatest((sum(seen * (bad / seen - {mean}) ** 2) - sum({mean} * (1 - {mean}))) "
            f"/ sum({mean} * (1 - {mean}) * (seen - 1)), {RHO_LEAST}), {RHO_MOST}) END FROM {table} WHERE seen > 0)"
        )

    return f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
cut AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (SELECT page_id, translate(h, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cut),
marks AS (SELECT doc_id, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY 1),
hosts AS (SELECT host, regexp_extract(host, '[^.]*[.]?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix,
  count(bad)::DOUBLE AS seen, coalesce(sum(bad), 0)::DOUBLE AS bad FROM parts LEFT JOIN marks ON doc_id = page_id GROUP BY 1),
s0 AS (SELECT suffix, sum(seen) AS seen, sum(bad) AS bad, (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(seen), 0) + 1) FROM hosts) AS mean FROM hosts GROUP BY 1),
s AS (SELECT suffix, (bad + (1 / rho - 1) * mean) / (seen + 1 / rho - 1) AS suffix_rate FROM s0, (SELECT {rho("s0", "mean")} AS rho)),
d0 AS (SELECT domain, suffix, sum(seen) AS seen, sum(bad) AS bad, any_value(suffix_rate) AS mean FROM hosts JOIN s USING (suffix) GROUP BY 1, 2),
d AS (SELECT domain, (bad + (1 / rho - 1) * mean) / (seen + 1 / rho - 1) AS domain_rate FROM d0, (SELECT {rho("d0", "mean")} AS rho)),
h0 AS (SELECT host, seen, bad, domain_rate AS mean FROM hosts JOIN d USING (domain)),
h1 AS (SELECT host, seen, 1 / rho - 1 AS k, (bad + (1 / rho - 1) * mean) / (seen + 1 / rho - 1) AS rate FROM h0, (SELECT {rho("h0", "mean")} AS rho)),
h AS (SELECT host, rate - {Z} * sqrt(rate * (1 - rate) / (seen + k + 1)) AS bound FROM h1)
SELECT page_id, host, path, CASE {names} END AS rule,
  coalesce(CASE {verdicts} END, CASE WHEN bound > {limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN h USING (host)"""
