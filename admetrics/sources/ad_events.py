"""Ad events derived from the ``lineitem`` table of the test data.

Grain: one row per campaign, channel and day, with a campaign for each supplier, so campaigns and events grow with the data. Money
is computed in whole cents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admetrics.schemas import RAW


def ad_events(spark: SparkSession, sf_dir) -> DataFrame:
    """Raw events with ``date`` as a date."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    discount = F.floor(F.col("l_discount") * 100 + 0.5)
    clicks = F.col("l_quantity").cast("long") - 1
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_suppkey").cast("long").alias("campaign"),
        (F.col("l_partkey") % 4).alias("placement"),
        F.col("l_shipdate").cast("date").alias("date"),
        clicks.alias("clicks"),
        (clicks * (15 + 10 * F.col("l_linenumber"))).alias("impressions"),
        F.when(F.col("l_returnflag") == "N", F.floor(clicks / 2)).otherwise(0).alias("conversions"),
        F.floor((cents * discount + 50) / 100).alias("spend"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(F.floor((cents + 2) / 4)).alias("revenue"),
    )
    measures = ["impressions", "clicks", "conversions", "spend", "revenue"]
    days = lines.groupBy("campaign", "placement", "date").agg(*[F.sum(c).alias(c) for c in measures])

    number = (F.col("campaign") + 1).cast("string")
    kind, placement = F.col("campaign") % 3, F.col("placement")
    named = days.select(
        F.concat(F.lit("C"), F.lpad(number, 12, "0")).alias("campaign_id"),
        F.concat(F.lit("Campaign "), number).alias("campaign_name"),
        F.when(kind == 0, "awareness")
        .when(kind == 1, "conversion")
        .otherwise("retargeting")
        .alias("campaign_type"),
        F.concat(F.lit("Advertiser "), (F.col("campaign") % 4).cast("string")).alias("advertiser"),
        F.when(placement < 2, "Google").otherwise("Meta").alias("platform"),
        F.when(placement == 0, "Google Search")
        .when(placement == 1, "Google Display")
        .when(placement == 2, "Meta Feed")
        .otherwise("Meta Stories")
        .alias("channel"),
        "date",
        *[F.col(c).cast("int") for c in ("impressions", "clicks", "conversions")],
        (F.col("spend") / 100).alias("spend_usd"),
        (F.col("revenue") / 100).alias("revenue_usd"),
    )
    day = F.col("date").cast("string")
    return named.withColumns(
        {
            "event_id": F.concat_ws("|", "campaign_id", "channel", day),
            "timestamp": F.concat(day, F.lit("T00:00:00Z")),
        }
    ).select(*RAW.names)

