"""URL filter: host reputation by empirical Bayes, and fixed rules.

Pages with a known outcome (bad or not) are counted by host. Counts are shrunk level by
level: suffixes towards all pages, registered domains towards their suffix, hosts towards
their domain. Each level is a beta-binomial whose prior has the mean of the level above and a
strength fitted by moments over the groups of that level. A host is blocked when the lower
posterior bound of its bad share, mean - z * deviation, is above the limit; so hosts
with few outcomes are blocked only if their surroundings are bad too.

A page takes the longest rule that fits its host (or a domain above it) and path, else its
host's verdict. All pages get a row: a null url, or one without ``://``, has empty host and
path and the verdict of the empty host. Outcomes that are null count as unknown, repeated
rows count as often as they occur; without any outcome nothing is blocked. Native functions
only. A host may hold any share of the pages: counts are combined before they move, and a hot
host's verdict is brought to its pages by a broadcast of bounded size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import tables

#: (host and path prefix, allow).
RULES = (
    ("org/", True), ("example.org/es/", False), ("example.org/en/1", False),
    ("com/fr/", True), ("com/de/", False),
)
#: Posterior deviations below the mean, and the bad share above which a host is blocked.
DEVIATIONS, LIMIT = 1.0, 0.25
# Second-level labels below which names are registered, as in example.co.uk.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, bool]]) -> Column:
    """The longest rule that fits, as text; null if none does."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda one: (len(one[0]), one[0])):
        own_host, own_path = _split_rule(rule)
        fits = ((host == own_host) | F.endswith(host, F.lit(f".{own_host}"))) & F.startswith(
            path, F.lit(own_path))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def registered_domain(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix); hosts of one label are both."""
    parts = F.split(host, r"\.")
    second = F.element_at(parts, -2)
    deep = (F.size(parts) > 2) & second.isin(*SECOND_LEVEL)
    suffix = F.when(deep, F.concat_ws(".", F.slice(parts, -2, 2))).otherwise(F.element_at(parts, -1))
    domain = F.when(F.size(parts) < 2, host).when(
        deep, F.concat_ws(".", F.slice(parts, -3, 3))).otherwise(F.concat_ws(".", F.slice(parts, -2, 2)))
    return domain, suffix


# Strength by moments: a group's count of bad pages varies by n m (1-m) (1 + (n-1) r) around
# n m, with r = 1 / (strength + 1); it is held between 1 and 1000 pages.
_STRENGTH = """coalesce(least(greatest(sum(n * (n - 1) * m * (1 - m))
    / nullif(greatest(sum((x - n * m) * (x - n * m) - n * m * (1 - m)), 0), 0) - 1, 1), 1000), 1000)"""

#: One statement for both engines, over host_counts(host, domain, suffix, pages, known, bad).
REPUTATION_SQL = f"""
WITH top AS (SELECT (sum(bad) + 1) / (sum(known) + 2) AS mean FROM host_counts),
suffixes AS (
  SELECT suffix, sum(known) AS n, sum(bad) AS x, (SELECT mean FROM top) AS m
  FROM host_counts GROUP BY suffix),
suffix_prior AS (SELECT {_STRENGTH} AS s FROM suffixes),
suffix_means AS (
  SELECT suffix, (x + m * (SELECT s FROM suffix_prior)) / (n + (SELECT s FROM suffix_prior)) AS m
  FROM suffixes),
domains AS (
  SELECT d.domain AS domain, n, x, m FROM (
    SELECT domain, suffix, sum(known) AS n, sum(bad) AS x
    FROM host_counts GROUP BY domain, suffix) AS d JOIN suffix_means AS u ON d.suffix = u.suffix),
domain_prior AS (SELECT {_STRENGTH} AS s FROM domains),
domain_means AS (
  SELECT domain, (x + m * (SELECT s FROM domain_prior)) / (n + (SELECT s FROM domain_prior)) AS m
  FROM domains),
hosts AS (
  SELECT host, pages, known AS n, bad AS x, m
  FROM host_counts AS h JOIN domain_means AS d ON h.domain = d.domain),
host_prior AS (SELECT {_STRENGTH} AS s FROM hosts),
posterior AS (
  SELECT host, pages, x + m * (SELECT s FROM host_prior) AS a,
    n - x + (1 - m) * (SELECT s FROM host_prior) AS b
  FROM hosts)
SELECT host, pages, a / (a + b) AS reputation,
  round(a / (a + b) - {{deviations}} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 9) > {{limit}}
    AS blocked
FROM posterior"""


def judged(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, bool]] = RULES,
           deviations: float = DEVIATIONS, limit: float = LIMIT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, reputation.

    ``outcomes`` has page_id and bad (boolean); of several outcomes of a page a bad one counts.
    """
    spark = pages.sparkSession
    rows = tables.stored(pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), "hosts")
    known = outcomes.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(
        F.max(F.col("bad").cast("int")).alias("bad"))
    domain, suffix = registered_domain(F.col("host"))
    counts = tables.stored(rows.join(known, "page_id", "left").groupBy("host").agg(
        F.count("*").alias("pages"), F.count("bad").cast("double").alias("known"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad")
    ).select("*", domain.alias("domain"), suffix.alias("suffix")), "host-counts")
    statement = REPUTATION_SQL.format(deviations=deviations, limit=limit)
    view = f"host_counts_{uuid.uuid4().hex}"
    counts.createOrReplaceTempView(view)
    reputation = tables.stored(spark.sql(statement.replace("host_counts", view)), "reputation")
    spark.catalog.dropTempView(view)
    placed = tables.attach(rows, reputation, "host", "pages")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    verdicts = F.when(F.col("rule").isNull(), F.when(F.col("blocked"), "block").otherwise("allow"))
    for name, allow in rules:
        verdicts = verdicts.when(F.col("rule") == name, "allow" if allow else "block")
    return placed.select("page_id", "host", "path", rule.alias("rule"), "blocked", "reputation").select(
        "page_id", "host", "path", "rule", verdicts.alias("verdict"), "reputation")


def _rule_sql() -> str:
    cases = []
    for rule, _ in sorted(RULES, key=lambda one: (-len(one[0]), one[0])):
        host, path = _split_rule(rule)
        cases.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) "
                     f"AND starts_with(path, '{path}') THEN '{rule}'")
    return "CASE " + " ".join(cases) + " END"


def _verdict_sql() -> str:
    cases = " ".join(f"WHEN rule = '{rule}' THEN '{'allow' if allow else 'block'}'"
                     for rule, allow in RULES)
    return f"CASE {cases} WHEN blocked THEN 'block' ELSE 'allow' END"


_SECOND = ", ".join(f"'{label}'" for label in SECOND_LEVEL)
#: Outcomes of pages are those of the labels with the same id: toxic or of low quality is bad.
ORACLE_SQL = f"""
WITH pages_split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}')
      AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
outcomes AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (toxic = 1 OR quality = 0) IS NOT NULL GROUP BY doc_id),
grouped AS (
  SELECT host, count(*) AS pages, CAST(count(bad) AS DOUBLE) AS known,
    CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad, string_split(host, '.') AS parts
  FROM pages_split LEFT JOIN outcomes USING (page_id) GROUP BY host),
host_counts AS (
  SELECT *, CASE WHEN len(parts) < 2 THEN host
      WHEN len(parts) > 2 AND parts[-2] IN ({_SECOND}) THEN array_to_string(parts[-3:], '.')
      ELSE array_to_string(parts[-2:], '.') END AS domain,
    CASE WHEN len(parts) > 2 AND parts[-2] IN ({_SECOND}) THEN array_to_string(parts[-2:], '.')
      ELSE parts[-1] END AS suffix
  FROM grouped),
reputations AS ({REPUTATION_SQL.format(deviations=DEVIATIONS, limit=LIMIT)}),
ruled AS (
  SELECT page_id, p.host AS host, path, {_rule_sql()} AS rule, blocked
  FROM (SELECT page_id, host, path, blocked FROM pages_split JOIN reputations USING (host)) AS p)
SELECT page_id, host, path, rule, {_verdict_sql()} AS verdict FROM ruled"""
