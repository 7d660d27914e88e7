"""Campaigns as they were on each day: versions with the days they hold for, and the as-of join of rows to them.

A campaign's day has one set of attributes, that of its last event (by timestamp, then by content). Days in a row with the same set are one version; it
holds from its first day until the first day of the next version. Attributes that come back later are a version of their own.

Nothing sorts or buffers event rows: they are reduced to one row per campaign and day before any window, map-side first, so a campaign with a third
of all rows is as cheap as its calendar is long. The as-of join is an equi-join on campaign and day, so a row meets one version however many its campaign has.

Rows without a campaign or a readable date belong to no version and find none, as in the other joins of the fact. Missing attributes are values like any others.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admetrics.operators.keys import with_key
from admetrics.schemas import CAMPAIGN_ATTRIBUTES, DIM_CAMPAIGN_VERSIONS

#: What tells versions apart.
VERSION = ["campaign_id", "valid_from"]


def campaign_versions(df: DataFrame) -> DataFrame:
    """campaign_id, attributes, valid_from, valid_to: the first day that no longer counts, null for the version of today."""
    rest = CAMPAIGN_ATTRIBUTES[1:]
    days = (
        df.where("campaign_id IS NOT NULL AND date IS NOT NULL")
        .groupBy("campaign_id", "date")
        .agg(F.max(F.struct("timestamp", *rest)).alias("_last"))
        .select("campaign_id", "date", F.struct(*[F.col(f"_last.{c}").alias(c) for c in rest]).alias("_now"))
    )
    in_order = Window.partitionBy("campaign_id").orderBy("date")
    changed = ~F.lag("_now").over(in_order).eqNullSafe(F.col("_now"))
    starts = days.withColumn("_changed", changed).where("_changed")
    return starts.select(
        "campaign_id", "_now.*", F.col("date").alias("valid_from"), F.lead("date").over(in_order).alias("valid_to")
    )


def dim_campaign_versions(df: DataFrame, number=with_key) -> DataFrame:
    """The versions with a key each. ``number`` gives the keys, like `with_key`."""
    return number(campaign_versions(df), VERSION, "campaign_key").select(*DIM_CAMPAIGN_VERSIONS.names)


def version_of_days(df: DataFrame, versions: DataFrame) -> DataFrame:
    """The campaign_key that holds on each (campaign_id, date) of the rows; days before the first version take the first.

    One pass in order of days over the days that occur and the days on which versions start.
    """
    days = df.where("campaign_id IS NOT NULL AND date IS NOT NULL").select("campaign_id", "date").distinct()
    key = versions.schema["campaign_key"].dataType
    marks = versions.select("campaign_id", F.col("valid_from").alias("date"), "campaign_key", F.lit(False).alias("_asked"))
    rows = marks.unionByName(days.withColumns({"campaign_key": F.lit(None).cast(key), "_asked": F.lit(True)}))
    # Rows of the same day are peers, so a version that starts on a day holds on it.
    so_far = Window.partitionBy("campaign_id").orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # One value for a campaign: a frame that begins at the row would be read to its end again for every row.
    first = Window.partitionBy("campaign_id").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = F.coalesce(F.last("campaign_key", ignorenulls=True).over(so_far), F.first("campaign_key", ignorenulls=True).over(first))
    return (
        rows.withColumn("campaign_key", held)
        .where(F.col("_asked") & F.col("campaign_key").isNotNull())
        .select("campaign_id", "date", "campaign_key")
    )


def as_of(df: DataFrame, versions: DataFrame) -> DataFrame:
    """The rows with the campaign_key of their day; rows whose campaign has no version drop out. No row is doubled."""
    return df.join(version_of_days(df, versions), ["campaign_id", "date"])
