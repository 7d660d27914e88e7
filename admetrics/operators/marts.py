"""Summaries over Silver, and the reports built on those summaries."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admetrics.functions.calendar import iso_year, month_label, month_start
from admetrics.functions.classify import roas_tier, scale_to_max
from admetrics.functions.exact import exact_mean, exact_sum
from admetrics.functions.ratios import exact_round, floor_ratio, null_ratio, pct
from admetrics.operators.ranges import RANGE_ROWS
from admetrics.operators.star import with_campaign_name
from admetrics.operators.windows import campaigns_fit
from admetrics.schemas import CAMPAIGN_ATTRIBUTES, CAMPAIGN_DAILY, CHANNEL_WEEKLY


#: Rows that a task sums by campaign and day, at about a kilobyte each.
DAY_ROWS = 250_000


def _money(name):
    return exact_sum(F.col(name))


def campaign_daily(df: DataFrame, ordered=True, most=RANGE_ROWS) -> DataFrame:
    """Per campaign and day; the ratio columns are means of the row ratios. A table that is stored needs no order.

    Most campaigns have a few rows a day, so sums made before the shuffle would hold nearly all rows of a task in memory and send as many. While no campaign has
    more than ``most`` rows, the rows are dealt by campaign and day and summed there, in ranges of both if the mart is ordered. Larger campaigns are combined first.
    The number of tasks follows the rows, as the sums of a day take far more room in memory than its row takes in the shuffle.
    """
    if campaigns_fit(df, most):
        n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / DAY_ROWS))
        df = df.repartitionByRange(n, "campaign_id", "date") if ordered else df.repartition(n, "campaign_id", "date")
    mart = (
        df.groupBy(*CAMPAIGN_ATTRIBUTES, "date")
        .agg(
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("conversions").alias("total_conversions"),
            _money("spend_usd").alias("total_spend"),
            _money("revenue_usd").alias("total_revenue"),
            exact_mean(F.col("ctr")).alias("avg_ctr"),
            exact_mean(F.col("roas")).alias("avg_roas"),
        )
        .select(*CAMPAIGN_DAILY.names)
    )
    return mart.orderBy("campaign_id", "date") if ordered else mart


def channel_weekly(df: DataFrame, iso_year_groups=False, ordered=True) -> DataFrame:
    """Per channel, platform, year and ISO week.

    The year is the calendar year, so 2024-12-30 counts as week 1 of 2024; ``iso_year_groups`` takes the
    year the ISO week belongs to.
    """
    year = iso_year("date") if iso_year_groups else F.year("date")
    mart = (
        df.withColumns({"year": year, "week": F.weekofyear("date")})
        .groupBy("channel", "platform", "year", "week")
        .agg(
            F.sum("impressions").alias("total_impressions"),
            F.sum("clicks").alias("total_clicks"),
            _money("spend_usd").alias("total_spend"),
            _money("revenue_usd").alias("total_revenue"),
            exact_mean(F.col("roas")).alias("avg_roas"),
            exact_mean(F.col("ctr")).alias("avg_ctr"),
        )
        .select(*CHANNEL_WEEKLY.names)
    )
    return mart.orderBy("year", "week", "channel") if ordered else mart


def campaign_channel_report(fact: DataFrame, dims: dict) -> DataFrame:
    """Impressions, CTR in percent, ROAS and spend per campaign and channel, largest spend first.

    The fact is summed per key pair before the joins, so the dimensions meet only those sums.
    """
    sums = fact.groupBy("campaign_key", "channel_key").agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        _money("spend_usd").alias("spend"),
        _money("revenue_usd").alias("revenue"),
    )
    return (
        sums.join(dims["dim_campaign"].select("campaign_key", "campaign_name"), "campaign_key")
        .join(dims["dim_channel"].select("channel_key", "channel_name"), "channel_key")
        .groupBy("campaign_name", "channel_name")
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            _money("spend").alias("total_spend"),
            _money("revenue").alias("revenue"),
        )
        .select(
            "campaign_name",
            "channel_name",
            "impressions",
            pct("clicks", "impressions").alias("ctr_pct"),
            exact_round(null_ratio("revenue", "total_spend"), 2).alias("roas"),
            "total_spend",
        )
        .orderBy(F.desc("total_spend"), "campaign_name", "channel_name")
    )


def kpi_totals(daily: DataFrame) -> DataFrame:
    """One row: the grand totals, overall ROAS and overall CTR in percent."""
    return daily.agg(
        F.sum("total_impressions").alias("total_impressions"),
        F.sum("total_clicks").alias("total_clicks"),
        _money("total_spend").alias("total_spend"),
        _money("total_revenue").alias("total_revenue"),
    ).select(
        "*",
        null_ratio("total_revenue", "total_spend").alias("overall_roas"),
        (null_ratio("total_clicks", "total_impressions") * 100).alias("overall_ctr_pct"),
    )


def _roas_of_sums(df: DataFrame, *by, **extra) -> DataFrame:
    return (
        df.groupBy(*by)
        .agg(
            _money("total_revenue").alias("_revenue"),
            _money("total_spend").alias("_spend"),
            *[c.alias(name) for name, c in extra.items()],
        )
        .withColumn("roas", floor_ratio("_revenue", "_spend"))
        .drop("_revenue", "_spend")
    )


def roas_by_campaign(daily: DataFrame, by="campaign_id") -> DataFrame:
    """Ratio of sums per campaign, worst first, with its tier; by id (plus a name) or by name."""
    extra = {"campaign_name": F.min("campaign_name")} if by == "campaign_id" else {}
    return (
        _roas_of_sums(daily, by, **extra)
        .withColumn("tier", roas_tier("roas"))
        .orderBy("roas", by)
    )


def monthly_roas(daily: DataFrame, dim: DataFrame) -> DataFrame:
    monthly = _roas_of_sums(daily.withColumn("month", month_start("date")), "campaign_id", "month")
    return (
        with_campaign_name(monthly, dim)
        .withColumn("month_label", month_label("month"))
        .orderBy("campaign_id", "month")
    )


def months(daily: DataFrame) -> DataFrame:
    return daily.select(month_label("date").alias("month_label")).distinct().orderBy("month_label")


def channel_efficiency(weekly: DataFrame) -> DataFrame:
    """Per channel: mean of the weekly CTRs, cost per click, and a size scaled to the largest spend."""
    return (
        weekly.groupBy("channel")
        .agg(
            exact_mean(F.col("avg_ctr")).alias("avg_ctr"),
            _money("total_spend").alias("total_spend"),
            F.sum("total_clicks").alias("total_clicks"),
        )
        .withColumn("avg_cpc", null_ratio("total_spend", "total_clicks"))
        .withColumn("size", scale_to_max("total_spend"))
        .orderBy("channel")
    )


def platform_share(weekly: DataFrame) -> DataFrame:
    # The window over all rows sees one row per platform.
    whole = exact_sum(F.col("total_spend"), window=Window.partitionBy())
    return (
        weekly.groupBy("platform")
        .agg(_money("total_spend").alias("total_spend"))
        .withColumn("share_pct", F.col("total_spend") / F.nullif(whole, F.lit(0.0)) * 100)
        .orderBy("platform")
    )


def funnel(daily: DataFrame) -> DataFrame:
    """Impressions, clicks, conversions as three rows with the rate from the step before."""
    totals = daily.agg(
        F.sum("total_impressions").alias("i"),
        F.sum("total_clicks").alias("c"),
        F.sum("total_conversions").alias("v"),
    )
    steps = F.stack(
        F.lit(3),
        *[F.lit(1), F.lit("Impressions"), F.col("i"), F.lit(None).cast("double")],
        *[F.lit(2), F.lit("Clicks"), F.col("c"), null_ratio("c", "i")],
        *[F.lit(3), F.lit("Conversions"), F.col("v"), null_ratio("v", "c")],
    )
    return totals.select(steps.alias("step", "stage", "value", "step_rate")).orderBy("step")


def weekly_pivot(weekly: DataFrame, channels=None) -> DataFrame:
    """Week rows x channel columns of impressions, 0 where a channel has none; years fall together.

    Naming the channels saves Spark the extra job that finds them.
    """
    pivot = weekly.groupBy("week").pivot("channel", channels).agg(F.sum("total_impressions"))
    return pivot.na.fill(0).orderBy("week")


def daily_spend(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("campaign_id", "date")
        .agg(_money("total_spend").alias("total_spend"))
        .orderBy("campaign_id", "date")
    )


def weekly_stacked(weekly: DataFrame) -> DataFrame:
    """Impressions per week and channel with the height of the channels stacked below."""
    below = Window.partitionBy("week").orderBy("channel").rowsBetween(Window.unboundedPreceding, -1)
    return (
        weekly.groupBy("week", "channel")
        .agg(F.sum("total_impressions").alias("impressions"))
        .withColumn("base", F.coalesce(F.sum("impressions").over(below), F.lit(0)))
        .withColumn("top", F.col("base") + F.col("impressions"))
        .orderBy("week", "channel")
    )


def preview(df: DataFrame, n, by) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*by).limit(n)
