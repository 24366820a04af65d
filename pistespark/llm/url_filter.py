"""URL filter: written rules first, empirical-Bayes host reputation for the rest.

Outcomes are labelled pages, bad or not. A host's bad share is shrunk towards its registered domain's, that
towards its suffix's, and that towards the share of all: at each level a beta prior has the parent's posterior
mean, and its strength comes from the data (the intra-class correlation of beta-binomial counts over all groups
of the level, by moments). A page is blocked if the lower bound of its host's posterior is above ``BLOCK_ABOVE``,
so a host with few labelled pages is blocked only where its parents' pages are bad too.

The registered query takes as outcomes the labels of the row with the page's id (bad: quality 0 or toxic 1);
``verdicts`` takes any table (page_id, bad). Rules are policy, not outcomes, and teach the model nothing.

Counts are partial aggregates, so a host with a third of all pages is a few rows; the join that hands a host's
posterior to its pages is one that AQE can split. Nothing is broadcast but what Spark finds small.

Defined results: a null url, or one without ``://``, has empty host and path, and is a host like any other;
a null page_id keeps its row; repeated rows count each; labels that repeat an id are bad if one of them is;
pages and labels may have other columns; without labels all is allowed; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pistespark.shared import spread_join

#: Fixed values: (host, path, verdict). A rule fits its host and all subdomains where the url's path starts with its path.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
#: Second labels under a two-letter country that are suffixes with it.
SECOND = ["ac", "co", "com", "edu", "gov", "net", "org"]
Z, BLOCK_ABOVE, LEAST_ICC, MOST_ICC = 1.645, 0.5, 0.001, 0.9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _two(host: str) -> str:
    return f"(split_part({host}, '.', -1) RLIKE '^[a-z][a-z]$' AND split_part({host}, '.', -2) IN ({', '.join(repr(x) for x in SECOND)}))"


def _level(df: DataFrame, key: str, parent: str) -> DataFrame:
    """One row per group of a level, with (n, bad) and the parent's mean ``m``: adds its own posterior mean.

    The strength is one number for the level: a one-row aggregate over all its groups, joined as such."""
    seen = F.col("n") > 0
    far = F.sum(F.when(seen, F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), 2) / (F.col("m") * (1 - F.col("m")))))
    icc = (far - F.sum(F.when(seen, F.lit(1.0)))) / F.nullif(F.sum(F.when(seen, F.col("n") - 1)), F.lit(0))
    strength = df.agg((1 / F.least(F.greatest(F.coalesce(icc, F.lit(LEAST_ICC)), F.lit(LEAST_ICC)), F.lit(MOST_ICC)) - 1).alias("s"))
    return df.crossJoin(F.broadcast(strength)).withColumn("mean", (F.col("bad") + F.col("s") * F.col("m")) / (F.col("n") + F.col("s")))


def reputation(hosts: DataFrame) -> DataFrame:
    """hosts: (host, n labelled, bad), a row per host. Returns host, n, mean, bound."""
    rows = hosts.withColumn("suffix", F.expr(f"CASE WHEN {_two('host')} THEN concat_ws('.', split_part(host, '.', -2), split_part(host, '.', -1)) ELSE split_part(host, '.', -1) END"))
    short = F.expr("substring(host, 1, greatest(0, length(host) - length(suffix) - 1))")
    rows = rows.withColumn("domain", F.when(short == "", F.col("host")).otherwise(F.concat_ws(".", F.substring_index(short, ".", -1), "suffix")))
    domains = rows.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    every = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("m"))
    suffixes = _level(suffixes.crossJoin(F.broadcast(every)), "suffix", "all").select("suffix", F.col("mean").alias("m"))
    domains = _level(domains.join(suffixes, "suffix"), "domain", "suffix").select("domain", F.col("mean").alias("m"))
    out = _level(spread_join(rows, domains, ["domain"]), "host", "domain")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("s") + 1))
    return out.select("host", "n", "mean", (F.col("mean") - Z * spread).alias("bound"))


def verdicts(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled. outcomes: (page_id, bad boolean), at most a row per id."""
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = rows.join(outcomes.select("page_id", F.col("bad").cast("long").alias("bad")), "page_id", "left")
    hosts = known.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    out = spread_join(rows, reputation(hosts), ["host"])
    method = F.when(F.col("bound") > BLOCK_ABOVE, "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, method).alias("verdict"), F.col("n").cast("long").alias("n_labelled"))


def labelled(labels: DataFrame) -> DataFrame:
    """Outcomes (page_id, bad) from the labels of the rows with the pages' ids."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(F.coalesce(F.bool_or(bad), F.lit(False)).alias("bad"))


def _sql_rules() -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN " for h, p, _ in ordered]
    pick = lambda i: "CASE " + " ".join(f + (f"'{h}{p}'" if i else f"'{v}'") for f, (h, p, v) in zip(fits, ordered, strict=True)) + " END"
    return f"{pick(1)} AS rule, {pick(0)} AS said"


def _sql_level(rows: str) -> str:
    return f"""(SELECT 1 / least(greatest(coalesce((sum(CASE WHEN n > 0 THEN n * pow(bad::double / n - m, 2) / (m * (1 - m)) END) - count(*) FILTER (n > 0))
      / nullif(sum(n - 1) FILTER (n > 0), 0), {LEAST_ICC}::double), {LEAST_ICC}::double), {MOST_ICC}::double) - 1 FROM {rows})"""


_TWO_SQL = f"(regexp_matches(split_part(host, '.', -1), '^[a-z][a-z]$') AND split_part(host, '.', -2) IN ({', '.join(repr(x) for x in SECOND)}))"
SQL = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM pages
), o AS (SELECT doc_id, coalesce(bool_or(quality = 0 OR toxic = 1), false) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, count(bad) AS n, coalesce(sum(bad::bigint), 0) AS bad FROM u LEFT JOIN o ON u.page_id = o.doc_id GROUP BY host),
h2 AS (SELECT *, CASE WHEN {_TWO_SQL} THEN split_part(host, '.', -2) || '.' || split_part(host, '.', -1) ELSE split_part(host, '.', -1) END AS suffix FROM h),
h3 AS (SELECT *, CASE WHEN length(host) <= length(suffix) + 1 THEN host
         ELSE split_part(substring(host, 1, length(host) - length(suffix) - 1), '.', -1) || '.' || suffix END AS domain FROM h2),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h3 GROUP BY ALL),
x AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
x1 AS (SELECT *, (SELECT (coalesce(sum(bad), 0) + 0.5::double) / (coalesce(sum(n), 0) + 1) FROM x) AS m FROM x),
x2 AS (SELECT suffix, (bad + s * m) / (n + s) AS m FROM x1, (SELECT {_sql_level('x1')} AS s)),
d1 AS (SELECT domain, n, bad, m FROM d JOIN x2 USING (suffix)),
d2 AS (SELECT domain, (bad + s * m) / (n + s) AS m FROM d1, (SELECT {_sql_level('d1')} AS s)),
h4 AS (SELECT host, n, bad, m FROM h3 JOIN d2 USING (domain)),
h5 AS (SELECT host, n, s, (bad + s * m) / (n + s) AS mean FROM h4, (SELECT {_sql_level('h4')} AS s)),
r AS (SELECT *, {_sql_rules()} FROM u)
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN mean - {Z}::double * sqrt(mean * (1 - mean) / (n + s + 1)) > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(n AS BIGINT) AS n_labelled
FROM r JOIN h5 USING (host)
"""
