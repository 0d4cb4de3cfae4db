"""URL rules by hashed expressions (DataFrame operations only).

A rule is `host/path`: it fits its host and all subdomains if the URL's path starts with
the rule's path. Each URL is expanded into expressions, every host suffix with every path
prefix that ends in `/` (and the empty one), at most as deep as the deepest rule: deeper
ones can match nothing. Rules are indexed by their host and their path up to its last `/`.
Expressions and rules meet in an equi-join on PREFIX hex digits of their SHA-256; the full
digest and the rest of the rule's path are confirmed after it. Of the rules that fit, the
longest wins (then the longer host, then block before allow).

A rule that very many URLs meet is one row on its side of the join: broadcast when the
rules are measured small, else a skewed join that AQE splits. The expressions of a URL are
aggregated to one row before the only other shuffle.

Edge cases: null URLs and those without `://` have empty host and path and the default
verdict; very long URLs are matched whole; repeated rows give a row each; no rules: every verdict is the default; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = 8
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL column."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, action, rule_host, rule_path, digest, short) of (action, rule) pairs."""
    if rules:
        rows = ", ".join(f"(:action{i}, :rule{i})" for i in range(len(rules)))
        raw = spark.sql(f"SELECT * FROM VALUES {rows} AS t(action, rule)",
                        args={f"{k}{i}": v for i, r in enumerate(rules) for k, v in zip(("action", "rule"), r)})
    else:
        raw = spark.sql("SELECT '' AS action, '' AS rule WHERE false")
    return prepare_rules(raw)


def prepare_rules(raw: DataFrame) -> DataFrame:
    """The same from a table (action, rule) of any size."""
    host = F.translate(F.regexp_extract("rule", "^[^/]*", 0), UPPER, LOWER)
    path = F.regexp_extract("rule", "^[^/]*(.*)$", 1)
    digest = F.sha2(F.concat("rule_host", F.regexp_extract("rule_path", "^(.*/)?", 0)), 256)
    return (raw.select("rule", "action", host.alias("rule_host"), path.alias("rule_path"))
            .withColumn("digest", digest).withColumn("short", F.substring("digest", 1, PREFIX)))


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Host suffixes of at most `labels` labels, each with the path prefixes of at most `slashes` slashes."""
    parts, steps = F.split(host, r"\."), F.split(path, "/")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), n - labels + 1), n),
                           lambda i: F.array_join(F.slice(parts, i, n), "."))
    depth = F.least(F.lit(slashes), F.size(steps) - 1)
    prefixes = F.when(depth >= 1, F.transform(F.sequence(F.lit(1), depth),
                                              lambda k: F.concat(F.array_join(F.slice(steps, 1, k), "/"), F.lit("/")))) \
        .otherwise(F.array().cast("array<string>"))
    prefixes = F.concat(F.array(F.lit("")), prefixes)
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(id, host, path, rule, verdict), one row per page; `rules` from `rule_table`."""
    depth = rules.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
                      F.max(F.length("rule_path") - F.length(F.replace("rule_path", F.lit("/"), F.lit("")))).alias("slashes")).first()
    host, path = split_url(F.col(f"`{url_col}`"))
    urls = pages.select(F.col(f"`{id_col}`").alias(id_col), host.alias("host"), path.alias("path"),
                        F.monotonically_increasing_id().alias("__row"))
    if depth.labels is None:
        return urls.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT).alias("verdict"))
    expanded = urls.select("*", F.explode(expressions(F.col("host"), F.col("path"), depth.labels, depth.slashes)).alias("e"))
    digest = F.sha2("e", 256)
    expanded = expanded.select("*", digest.alias("e_digest"), F.substring(digest, 1, PREFIX).alias("short")).drop("e")
    met = expanded.join(rules, "short", "left")
    fits = (F.col("digest") == F.col("e_digest")) & F.startswith("path", "rule_path")
    rank = F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), (F.col("action") == "block").alias("block"),
                    "rule", "action")
    best = met.groupBy("__row", id_col, "host", "path").agg(F.max(F.when(fits, rank)).alias("best"))
    return best.select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.action", F.lit(DEFAULT)).alias("verdict"))
