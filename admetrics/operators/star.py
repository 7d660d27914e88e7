"""Dimensions, surrogate keys and the fact table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admetrics.functions.calendar import calendar
from admetrics.functions.classify import channel_type
from admetrics.functions.ratios import exact_round
from admetrics.operators import history
from admetrics.operators.keys import with_key
from admetrics.schemas import CAMPAIGN_ATTRIBUTES, DIM_CAMPAIGN, DIM_CHANNEL, DIM_DATE


def dim_campaign(df: DataFrame, latest=False, number=with_key) -> DataFrame:
    """One row per distinct set of attributes; with ``latest`` the newest set of each campaign only."""
    if latest:
        rest = CAMPAIGN_ATTRIBUTES[1:]
        members = (
            df.groupBy("campaign_id")
            .agg(F.max(F.struct("date", *rest)).alias("newest"))
            .select("campaign_id", *[f"newest.{c}" for c in rest])
        )
    else:
        members = df.select(*CAMPAIGN_ATTRIBUTES).distinct()
    return number(members, CAMPAIGN_ATTRIBUTES, "campaign_key").select(*DIM_CAMPAIGN.names)


def dim_channel(df: DataFrame, latest=False, number=with_key) -> DataFrame:
    named = df.withColumnRenamed("channel", "channel_name")
    if latest:
        members = (
            named.groupBy("channel_name")
            .agg(F.max(F.struct("date", "platform")).alias("newest"))
            .select("channel_name", "newest.platform")
        )
    else:
        members = named.select("channel_name", "platform").distinct()
    typed = members.withColumn("channel_type", channel_type("channel_name"))
    return number(typed, ["channel_name", "platform"], "channel_key").select(*DIM_CHANNEL.names)


def dim_date(df: DataFrame) -> DataFrame:
    """The dates that occur, with their calendar attributes."""
    days = df.select(F.col("date").alias("full_date")).distinct()
    return calendar(days, "full_date").select(*DIM_DATE.names)


def attach_keys(df: DataFrame, dims: dict) -> DataFrame:
    """Inner joins to the three dimensions.

    No broadcast is forced: Spark compares the size of each dimension with its own threshold. Versions of campaigns are joined as
    of the row's day.
    """
    channel = dims["dim_channel"].select(F.col("channel_name").alias("channel"), "channel_key")
    date = dims["dim_date"].select(F.col("full_date").alias("date"), "date_key")
    if "valid_from" in dims["dim_campaign"].columns:
        keyed = history.as_of(df, dims["dim_campaign"])
    else:
        keyed = df.join(dims["dim_campaign"].select("campaign_id", "campaign_key"), "campaign_id")
    return keyed.join(channel, "channel").join(date, "date")


def fact(df: DataFrame, dims: dict) -> DataFrame:
    return attach_keys(df, dims).select(
        "event_id",
        "campaign_key",
        "date_key",
        "channel_key",
        "impressions",
        "clicks",
        "conversions",
        "spend_usd",
        "revenue_usd",
        exact_round("ctr", 4).alias("ctr"),
        exact_round("cpc", 4).alias("cpc"),
        exact_round("roas", 4).alias("roas"),
        exact_round("rolling_7d_impressions", 1).alias("rolling_7d_impressions"),
        exact_round("rolling_7d_spend", 2).alias("rolling_7d_spend"),
        "running_total_spend",
        "roas_rank_in_channel",
    )


def with_campaign_name(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds the campaign's name; one name per id, the first in the alphabet if it has several."""
    names = dim.groupBy("campaign_id").agg(F.min("campaign_name").alias("campaign_name"))
    return df.join(names, "campaign_id", "left")


def fact_where(fact: DataFrame, dims: dict, **conditions) -> DataFrame:
    """The fact rows whose dimension rows meet conditions: ``fact_where(fact, dims, date="year = 1995", campaign="advertiser = 'A'")``.

    The conditions stay on the dimensions, whose keys filter the fact: on a fact partitioned by ``date_key`` Spark then prunes the folders of other
    days while it plans the stages, and may test the other keys against a bloom filter in the scan. A row without the dimension row drops out;
    none is doubled.
    """
    keys = {"campaign": "campaign_key", "channel": "channel_key", "date": "date_key"}
    for name, condition in conditions.items():
        fact = fact.join(dims[f"dim_{name}"].where(condition).select(keys[name]), keys[name], "left_semi")
    return fact
