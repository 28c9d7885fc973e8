"""URL filters: host-suffix and path-prefix expressions, short digests, rule precedence.

Each distinct URL is expanded into expressions ``host suffix + path prefix``,
with path prefixes only of the lengths that rules have.  Expressions meet the
rules on the first bytes of their SHA-256, as in a list of hash prefixes;
a meeting counts only if the whole digests are equal.  The longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, spread_join

#: (verdict, host, path), as the contract of op9 gives them
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Rules are broadcast up to this many (some 10 MB), else joined by shuffle.
BROADCAST_RULES = 100_000
#: Bytes of a digest that expressions and rules meet on.
PREFIX_BYTES = 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """rule, verdict, length, digest and its short prefix, one row per distinct rule.

    Of rules with the same host and path, block goes before allow.
    """
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    table = table.groupBy(F.concat("host", "path").alias("rule"), F.char_length("path").alias("depth")).agg(F.max("verdict").alias("verdict"))
    digest = F.sha2(F.concat_ws("\n", F.col("depth").cast("string"), "rule"), 256)
    return table.select("rule", "verdict", F.char_length("rule").alias("length"), digest.alias("digest"), F.substring(digest, 1, 2 * PREFIX_BYTES).alias("short"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, ...): page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the
    rule's path.  ``rule`` is host + path of the longest that fits, else null,
    and the verdict is then ``default``.  A null url, or one without ``://``,
    has an empty host and path.  Repeated pages are answered once per row.
    Other columns are ignored whatever their names.  An empty table gives an
    empty result.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, _, p in rules})
    depth = max((h.count(".") + 1 for _, h, _ in rules), default=0)
    # a url is expanded once, however many pages have its host and path's start
    start = F.substring("path", 1, max(lengths, default=0))
    parts = parts.withColumn("start", start)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(depth, 1)))), lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."))
    distinct = cut(parts.groupBy("host", "start").agg(F.count("*").alias("pages")), "op9-distinct")
    keyed = distinct.select("host", "start", F.explode(suffixes).alias("suffix"))
    keyed = keyed.select("host", "start", "suffix", F.explode(F.array(*map(F.lit, lengths or [0]))).alias("n")).where(F.char_length("start") >= F.col("n"))
    digest = F.sha2(F.concat_ws("\n", F.col("n").cast("string"), F.concat("suffix", F.expr("substring(start, 1, n)"))), 256)
    keyed = keyed.select("host", "start", digest.alias("full")).withColumn("short", F.substring("full", 1, 2 * PREFIX_BYTES))
    table = rule_table(spark, rules)
    table = F.broadcast(table) if len(rules) <= broadcast_rules else table
    met = keyed.join(table, "short").where(F.col("full") == F.col("digest"))
    best = met.groupBy("host", "start").agg(F.max(F.struct("length", "rule", "verdict")).alias("best"))
    best = best.select("host", "start", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    answers = cut(distinct.join(best, ["host", "start"], "left"), "op9-answers")
    return spread_join(parts, answers, ["host", "start"], "pages", pages.count()).select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


ORACLE = """
WITH parts AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT s.page_id, s.host, s.path, rhost || rpath AS rule, verdict, length(rhost || rpath) AS n
  FROM split s LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, n) AS rule,
       coalesce(arg_max(verdict, n), 'allow') AS verdict
FROM fits GROUP BY page_id
"""
