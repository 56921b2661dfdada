"""URL rules by hashed expressions, the way a local block list of hash prefixes is looked up.

A rule is a host and a path; it fits that host and its subdomains where the URL's path starts with the rule's path. Each
distinct (host, path) of the pages is expanded to expressions, every host suffix of whole labels with every prefix of the path,
for the numbers of labels and the lengths of paths that occur among the rules. Expressions and rules meet in
an equi-join on the first ``PREFIX`` hex digits of their SHA-256; equal full digests confirm a match. The longest rule wins, of
equally long ones the longer host, then block. URLs that no rule fits get ``default``.

Null URLs and URLs without ``://`` have an empty host and path and fit no rule. Rows may repeat and each is judged; other
columns of the pages are not read. Rules may be empty; of rules with the same host and path block holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: fixed values: the rules that the query applies (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows as a DataFrame of literals."""
    rows = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) of every page."""
    parts = pages.select(F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    ruled = (rules.groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).agg(F.max("verdict").alias("verdict"))
             .withColumn("rule", F.concat("rule_host", "rule_path")).withColumn("digest", F.sha2("rule", 256))
             .withColumn("short", F.substring("digest", 1, PREFIX)))
    shapes = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = sorted(shapes["labels"]), sorted(shapes["lengths"])  # as many as rules differ in shape
    names = F.split("host", r"\.")
    hosts = F.array(*[F.when(F.size(names) >= n, F.array_join(F.slice(names, -n, n), ".")) for n in labels])
    paths = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n) if n else F.lit("")) for n in lengths])
    expressions = (parts.select("host", "path").distinct()
                   .select("host", "path", F.explode(hosts).alias("suffix"), paths.alias("paths")).filter("suffix is not null and suffix != ''")
                   .select("host", "path", "suffix", F.explode("paths").alias("prefix")).filter("prefix is not null")
                   .withColumn("full", F.sha2(F.concat("suffix", "prefix"), 256)).withColumn("short", F.substring("full", 1, PREFIX)))
    matched = (expressions.join(ruled, "short")
               .filter((F.col("full") == F.col("digest")) & (F.col("suffix") == F.col("rule_host")) & (F.col("prefix") == F.col("rule_path"))))
    order = F.struct(F.length("rule"), F.length("rule_host"), F.col("verdict"))
    best = matched.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    return (parts.join(best, ["host", "path"], "left")
            .select(key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
