"""URL rules by host suffix and path prefix.

Each distinct URL is expanded into expressions host suffix + path prefix, only with the label counts and path lengths that
occur among the rules, and these are joined with the rules on the first 32 bits of their SHA-256. A hit
counts after the whole digest agrees. The longest expression wins; of equally long ones that with the longer host, then a block.

Defined cases: a null URL and one without `://` have an empty host and path and meet no rule. A URL without a rule gets `default`.
Repeated rows and repeated rules change nothing. Other columns of the input are carried along, unless they bear
the names of result columns. Empty tables give empty results; with no rules every URL gets `default`. Spark picks the join from the
sizes it knows; a hot URL is expanded once, and its rows are split by adaptive execution if the join shuffles.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SHORT = 8


def host_of(url):
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _labels(host):
    return F.when(host == "", 0).otherwise(F.size(F.split(host, r"\.")))


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    """Rules from (action, host, path) tuples; the path is empty or starts with a slash."""
    for action, host, path in rules:
        if action not in ("allow", "block") or "/" in host or path and path[0] != "/":
            raise ValueError(f"not a rule: {(action, host, path)}")
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def digested(rules: DataFrame) -> DataFrame:
    rule = F.concat(F.translate("host", _UPPER, _UPPER.lower()), F.col("path"))
    return (
        rules.where("action IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL")
        .select("action", rule.alias("rule"), F.length("host").alias("host_chars"))
        .withColumn("digest", F.sha2("rule", 256))
        .withColumn("short", F.substring("digest", 1, _SHORT))
    )


def hits(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The winning rule of each distinct URL that has one: url, rule, action."""
    shape = rules.where("host IS NOT NULL AND path IS NOT NULL").agg(
        F.collect_set(_labels(F.col("host"))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")
    ).first()
    labels = F.array(*map(F.lit, sorted(shape.labels))).cast("array<int>")
    lengths = F.array(*map(F.lit, sorted(shape.lengths))).cast("array<int>")
    host, path = F.col("host"), F.col("path")
    suffixes = F.transform(
        F.filter(labels, lambda k: _labels(host) >= k),
        lambda k: F.when(k == 0, "").otherwise(F.array_join(F.slice(F.split(host, r"\."), -F.greatest(k, F.lit(1)), F.greatest(k, F.lit(1))), ".")),
    )
    prefixes = F.transform(F.filter(lengths, lambda n: F.length(path) >= n), lambda n: F.substring(path, F.lit(1), n))
    wanted = (
        urls.select("url")
        .where("url IS NOT NULL")
        .distinct()
        .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .select("url", F.explode(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))).alias("wanted"))
        .withColumn("wanted", F.sha2("wanted", 256))
        .withColumn("short", F.substring("wanted", 1, _SHORT))
    )
    rank = F.struct(F.length("rule"), "host_chars", "action")
    return (
        wanted.join(digested(rules), "short")
        .where("wanted = digest")
        .groupBy("url")
        .agg(F.max_by(F.struct("rule", "action"), rank).alias("hit"))
        .select("url", "hit.rule", "hit.action")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url="url", default="allow") -> DataFrame:
    """The input with host, path, rule (null without one) and verdict."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    row = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{url}`").alias("url"))
    found = hits(row, rules)
    return row.join(found, "url", "left").select(
        "row.*",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("action", F.lit(default)).alias("verdict"),
    )
