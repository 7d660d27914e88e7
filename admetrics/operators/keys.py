"""Surrogate keys: dense ranks by content, and keys that stay when members are added."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_key(df: DataFrame, order_cols, name) -> DataFrame:
    """Numbers the rows 0, 1, 2 ... by content alone, without passing all of them through one task.

    Rows are dealt into 4,096 buckets by the first three digits of an MD5 over ``order_cols``, numbered
    within the bucket, and moved up by the size of the buckets before. The same members always get the
    same keys. ``order_cols`` must tell the rows apart.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.concat_ws("|", *order_cols)), 1, 3))
    inside = Window.partitionBy("_bucket").orderBy(*order_cols)
    # At most 4,096 rows, one per bucket: safe in a single window and safe to broadcast.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_bucket")
        .count()
        .select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    return (
        bucketed.withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_bucket", "_place", "_start")
    )


def _same(left, right, columns):
    """Equal in all columns, where null equals null."""
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]


def new_keys(known: DataFrame, members: DataFrame, order_cols, name) -> DataFrame:
    """Keys for the members that ``known`` lacks, numbered after its last key; ``known`` and the result have ``order_cols`` and ``name``."""
    fresh = members.select(*order_cols).distinct().alias("m")
    fresh = fresh.join(known.alias("k"), _same("m", "k", order_cols), "left_anti")
    start = known.agg(F.max(name)).first()[0]
    numbered = with_key(fresh, order_cols, name)
    return numbered.withColumn(name, F.col(name) + F.lit(0 if start is None else start + 1))


def with_known_key(members: DataFrame, known: DataFrame, order_cols, name) -> DataFrame:
    """The members with the keys that ``known`` gives them."""
    found = members.alias("m").join(known.alias("k"), _same("m", "k", order_cols))
    return found.select("m.*", f"k.{name}")
