"""URL rules by hashed expressions, in DataFrame functions only.

Every URL is expanded into the (host suffix, path prefix) expressions that some
rule could equal: as many trailing host labels and as many leading path
characters as a rule has. The expressions meet the rules by an equi-join on the
first four bytes of their digest; a full digest confirms the match and the rule
of highest precedence decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hourloom.llm.common import LOWER, UPPER

Rule = tuple[str, str, str]

#: Rows of one broadcast of rules; more rules are joined by a shuffle of the expressions.
BROADCAST_RULES = 100_000


def url_host(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules (verdict, host, path) as a table."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path")) for v, h, p in rules]
    none = "array<struct<verdict:string,rule_host:string,rule_path:string>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(none)))


def expression(host: str | Column, path: str | Column) -> Column:
    # A host holds no slash, so the first NUL-free split of this text is unique.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def digest_prefix(digest: str) -> Column:
    return F.substring(digest, 1, 8)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_column: str = "page_id",
    url: str = "url",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """Return page_id, host, path, rule and verdict, one row per input row.

    ``rules`` has verdict, rule_host and rule_path. A rule fits its host and all
    subdomains whose path starts with the rule's. The longest rule (host and
    path together) wins, then the longer host, then block before allow, then
    the smaller text. No fitting rule: null and ``default``. A missing url, or
    one without ://, has an empty host and path. Missing ids and repeated rows
    keep their rows; long hosts give no more expressions than the rules have
    shapes. Rules with a missing host or path fit nothing.
    """
    rules = rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL").select(
        "verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_length"),
        F.size(F.split("rule_host", r"\.", -1)).alias("labels"),
        F.length("rule_path").alias("path_length"),
        expression("rule_host", "rule_path").alias("rule_digest"),
    )
    # One row of sums over the rules: their shapes, pairs of small integers.
    shapes = rules.agg(
        F.sort_array(F.collect_set(F.struct("labels", "path_length"))).alias("shapes"), F.count(F.lit(1)).alias("rules")
    ).first()
    shape_values = F.array(
        *[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.path_length).alias("path_length")) for s in shapes.shapes]
    ).cast("array<struct<labels:int,path_length:int>>")

    # The id of a row is its place in the scan, so that repeated rows stay apart.
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url")).select(
        F.monotonically_increasing_id().alias("row"), "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    labels = F.split("host", r"\.", -1)
    fitting = F.filter(shape_values, lambda s: (s.labels <= F.size(labels)) & (s.path_length <= F.length("path")))
    expressions = F.transform(
        fitting, lambda s: expression(F.call_function("substring_index", F.col("host"), F.lit("."), -s.labels), F.col("path").substr(F.lit(1), s.path_length))
    )
    expanded = rows.withColumn("digest", F.explode_outer(expressions)).withColumn("prefix", digest_prefix("digest"))
    lookups = rules.withColumn("prefix", digest_prefix("rule_digest"))
    if shapes.rules <= broadcast_rules:
        lookups = F.broadcast(lookups)
    met = expanded.join(lookups, "prefix", "left").withColumn("fits", F.col("digest") == F.col("rule_digest"))
    rank = F.struct(
        F.length("rule"), "host_length", (F.col("verdict") == "block").alias("blocks"), F.col("rule").alias("rule"), "verdict"
    )
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max(F.when(F.col("fits"), rank)).alias("best"))
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
