"""URL filters: host reputation by hierarchical beta-binomial shrinkage, under explicit rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, whole

# The rules of the query: (verdict, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_RULES = 500

# Suffixes of two labels below which names are registered; other suffixes are the last label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "ne.jp", "org.au", "org.uk")

# A host is blocked if its bad rate lies above this with about 95 % certainty.
MAX_BAD_RATE = 0.5
Z = 1.645
# Bounds of the prior strengths, in pages.
MIN_STRENGTH, MAX_STRENGTH = 0.5, 10_000.0


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*TWO_LABEL_SUFFIXES), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(last_two)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null. Rules are settings: a few, not a table."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"At most {MAX_RULES} rules, not {len(rules)}.")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _shrunk(counts: DataFrame, level: str, above: DataFrame | float, parent: str | None) -> DataFrame:
    """Posterior ``a`` and ``b`` per ``level``, its prior centred on the mean of ``parent``.

    The strength of the prior follows from moments: with mean m, the squared
    deviation of x bad among n pages is n m (1 - m) (1 + (n - 1) r), r = 1 / (strength + 1).
    """
    own = counts.groupBy(level, *([parent] if parent else [])).agg(F.sum("bad").alias("x"), F.sum("n").alias("n"))
    if parent:
        seen = own.join(above.select(F.col(parent), F.col("mean").alias("m")), parent)
    else:
        seen = own.withColumn("m", F.lit(above))
    noise = F.col("m") * (1 - F.col("m"))
    deviation = (F.col("x") - F.col("n") * F.col("m")) * (F.col("x") - F.col("n") * F.col("m")) - F.col("n") * noise
    r = F.sum(deviation) / F.nullif(F.sum(F.col("n") * (F.col("n") - 1) * noise), F.lit(0.0))
    bounded = F.least(F.greatest(F.coalesce(r, F.lit(0.0)), F.lit(1 / (MAX_STRENGTH + 1))), F.lit(1 / (MIN_STRENGTH + 1)))
    strength = F.lit(seen.agg(1 / bounded - 1).first()[0])
    a = F.col("x") + strength * F.col("m")
    b = F.col("n") - F.col("x") + strength * (1 - F.col("m"))
    return seen.select(level, a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"))


def reputation(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, float]:
    """Posteriors of hosts, domains, suffixes and all, from (host, bad); empty outcomes give mean one half."""
    counts = outcomes.where(F.col("bad").isNotNull()).groupBy("host").agg(
        F.sum(F.col("bad").cast("double")).alias("bad"), F.count(F.lit(1)).cast("double").alias("n")
    ).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    everything = counts.agg(
        (F.coalesce(F.sum("bad"), F.lit(0.0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1)
    ).first()[0]
    suffixes = _shrunk(counts, "suffix", everything, None)
    domains = _shrunk(counts, "domain", suffixes, "suffix")
    hosts = _shrunk(counts, "host", domains, "domain")
    return hosts, domains, suffixes, everything


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, max_bad_rate: float = MAX_BAD_RATE, z: float = Z
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate, bad_rate_low`` of every row of ``pages``.

    ``outcomes`` has (url, bad): 1 for a bad page, 0 for a good one; rows with a null
    outcome are left out. A rule decides where one fits; else a page is blocked if
    the lower posterior bound of its host's bad rate is above ``max_bad_rate``. A host
    without outcomes has the posterior of its domain, or of its suffix, or of all.
    Null urls and urls without ``://`` have empty host and path. Repeated and null ids
    stay as they are, other columns are not read, empty tables are allowed.
    """
    hosts, domains, suffixes, everything = reputation(outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad")))
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = parsed.select("host").distinct().withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    level = lambda df, key, p: df.select(key, F.col("a").alias(f"{p}a"), F.col("b").alias(f"{p}b"))
    known = (
        known.join(level(hosts, "host", "h"), "host", "left")
        .join(level(domains, "domain", "d"), "domain", "left")
        .join(level(suffixes, "suffix", "s"), "suffix", "left")
    )
    a = F.coalesce("ha", "da", "sa", F.lit(everything))
    b = F.coalesce("hb", "db", "sb", F.lit(1 - everything))
    mean = a / (a + b)
    low = mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))
    rated = known.select("host", mean.alias("bad_rate"), low.alias("bad_rate_low"))
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_rate_low") > max_bad_rate, F.lit("block")).otherwise(F.lit("allow"))
    return parsed.join(rated, "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, method).alias("verdict"), "bad_rate", "bad_rate_low"
    )


def outcomes_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages whose url ends in the number of a labelled document: toxic or of low quality is bad."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})[^/]*/?$", 1)
    linked = pages.select("url", F.when(number != "", number.cast("bigint")).alias("_doc"))
    graded = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.greatest(F.coalesce("toxic", F.lit(0)), 1 - F.coalesce("quality", F.lit(1)))).alias("bad")
    )
    return linked.join(graded, linked["_doc"] == graded["doc_id"]).select("url", "bad")


def url_digest(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns the url query returns."""
    done = filter_urls(pages, outcomes_of(pages, labels))
    return done.select("page_id", "host", "path", "rule", "verdict")


URL_SQL = rf"""
WITH parsed AS (
    SELECT page_id, coalesce(url, '') AS u,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), named AS (
    SELECT *, string_split(host, '.') AS p FROM parsed
), split AS (
    SELECT page_id, host, path,
        CASE WHEN array_to_string(p[-2:], '.') IN {TWO_LABEL_SUFFIXES} THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain,
        CASE WHEN array_to_string(p[-2:], '.') IN {TWO_LABEL_SUFFIXES} THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix,
        try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})[^/]*/?$', 1), '') AS BIGINT) AS doc
    FROM named
), graded AS (
    SELECT doc_id, max(greatest(coalesce(toxic, 0), 1 - coalesce(quality, 1))) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), counts AS (
    SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, sum(bad)::DOUBLE AS bad, count(*)::DOUBLE AS n
    FROM split JOIN graded ON doc = doc_id GROUP BY host
), g AS (
    SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) AS m FROM counts
), s0 AS (
    SELECT suffix, sum(bad) AS x, sum(n) AS n, any_value(g.m) AS m FROM counts, g GROUP BY suffix
), sk AS (
    SELECT 1 / least(greatest(coalesce(sum((x - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0), {1 / (MAX_STRENGTH + 1)}), {1 / (MIN_STRENGTH + 1)}) - 1 AS k FROM s0
), s AS (
    SELECT suffix, x + k * m AS a, n - x + k * (1 - m) AS b FROM s0, sk
), d0 AS (
    SELECT domain, suffix, sum(bad) AS x, sum(n) AS n, any_value(a / (a + b)) AS m FROM counts JOIN s USING (suffix) GROUP BY domain, suffix
), dk AS (
    SELECT 1 / least(greatest(coalesce(sum((x - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0), {1 / (MAX_STRENGTH + 1)}), {1 / (MIN_STRENGTH + 1)}) - 1 AS k FROM d0
), d AS (
    SELECT domain, x + k * m AS a, n - x + k * (1 - m) AS b FROM d0, dk
), h0 AS (
    SELECT host, bad AS x, n, a / (a + b) AS m FROM counts JOIN d USING (domain)
), hk AS (
    SELECT 1 / least(greatest(coalesce(sum((x - n * m) ** 2 - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0), {1 / (MAX_STRENGTH + 1)}), {1 / (MIN_STRENGTH + 1)}) - 1 AS k FROM h0
), h AS (
    SELECT host, x + k * m AS a, n - x + k * (1 - m) AS b FROM h0, hk
), rated AS (
    SELECT page_id, split.host, path, coalesce(h.a, d.a, s.a, g.m) AS a, coalesce(h.b, d.b, s.b, 1 - g.m) AS b
    FROM split LEFT JOIN h ON split.host = h.host LEFT JOIN d ON split.domain = d.domain LEFT JOIN s ON split.suffix = s.suffix, g
), ruled AS (
    SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM rated
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
         WHEN a / (a + b) - {Z} * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) > {MAX_BAD_RATE} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
