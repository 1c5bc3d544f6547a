"""URL filter lists matched by hashed host-suffix / path-prefix expressions.

A rule is (host, path, verdict). It fits its host and every subdomain when the
url's path starts with the rule's path. Each url is expanded into the host
suffixes and path prefixes that could be a rule; the expressions meet the list in
an equi-join on the first four bytes of their SHA-256 digest; the full digests
are then compared, and of all rules that fit a url the longest wins (equal
expressions: block before allow).

The work is done per distinct url, so a url with a third of all rows counts once
before anything is shuffled; the verdicts join back to the rows by url.

Edge cases: a null url, or one without ``://``, has an empty host and path and no
rule; repeated rows keep their number; an empty table gives an empty result; an
empty rule list gives every url the default verdict. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import fresh, named

PREFIX_HEX = 8  # four bytes, as short list entries have
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://`` up to ``?``, ``#`` or the end; empty without it."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^?#]*", 0), F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"(?s)^[^/]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"(?s)^[^/]*(.*)$", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def hash_rules(rules: DataFrame) -> DataFrame:
    """The filter list as it is matched: (prefix, digest, rule, verdict), one row per expression; block wins a tie."""
    rule = F.concat(F.coalesce(F.col("host"), F.lit("")), F.coalesce(F.col("path"), F.lit("")))
    one = rules.groupBy(rule.alias("rule"), F.length("host").alias("_hlen"), F.length("path").alias("_plen")) \
        .agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
    # the separator keeps host and path apart, so a.b + /c never meets a.b/ + c
    split = F.concat(F.substring("rule", F.lit(1), F.col("_hlen")), F.lit("\n"), F.substring("rule", F.col("_hlen") + 1, F.col("_plen")))
    digest = _digest(split)
    return one.select(F.substring(digest, 1, PREFIX_HEX).alias("prefix"), digest.alias("digest"), "rule", "verdict", "_plen")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict; clashing column names get underscores in front."""
    listed = hash_rules(rules)
    # path prefixes are taken at the lengths that rule paths have; no more than the longest rule path has characters
    lengths = sorted(r[0] for r in listed.select("_plen").distinct().collect() if r[0] is not None)
    url = named(url_col)
    urls = pages.select(url.alias("_url")).filter(F.contains("_url", F.lit("://"))).distinct()
    urls = urls.select("_url", url_host(F.col("_url")).alias("_host"), url_path(F.col("_url")).alias("_path"))
    urls = urls.filter(F.col("_host") != "")
    labels = F.split(F.col("_host"), r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size("_labels")),
                           lambda i: F.array_join(F.slice("_labels", i, F.size("_labels")), "."))
    prefixes = F.transform(F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length("_path")),
                           lambda n: F.substring(F.col("_path"), F.lit(1), n))
    spread = urls.withColumn("_labels", labels).withColumn("_suffix", F.explode(suffixes)) \
        .withColumn("_prefix", F.explode(prefixes))
    spread = spread.select("_url", _digest(F.concat("_suffix", F.lit("\n"), "_prefix")).alias("_d"))
    spread = spread.select("_url", "_d", F.substring("_d", 1, PREFIX_HEX).alias("prefix"))
    hits = spread.join(listed.drop("_plen"), "prefix").filter(F.col("_d") == F.col("digest"))
    best = hits.groupBy("_url").agg(F.max(F.struct(F.length("rule").alias("len"), F.col("verdict"), F.col("rule"))).alias("_best"))
    names = {c: fresh(pages.columns, c) for c in ("host", "path", "rule", "verdict")}
    key, judged = fresh(pages.columns, "_key"), fresh(pages.columns, "_judged")
    best = best.select(F.col("_url").alias(key), F.col("_best").alias(judged))
    # a url without "://" meets no verdict, so its rows need not meet in one place; null ones would
    apart = F.concat(F.lit(" "), F.xxhash64(*[named(c) for c in pages.columns]).cast("string"))
    keyed = pages.withColumn(key, F.when(F.contains(url, F.lit("://")), url).otherwise(apart))
    joined = keyed.join(best, key, "left")
    return joined.select(*[named(c) for c in pages.columns],
                         F.coalesce(url_host(url), F.lit("")).alias(names["host"]),
                         F.coalesce(url_path(url), F.lit("")).alias(names["path"]),
                         F.col(judged)["rule"].alias(names["rule"]),
                         F.coalesce(F.col(judged)["verdict"], F.lit(default)).alias(names["verdict"]))
