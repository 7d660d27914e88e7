"""KPI measures in any grouping context."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admetrics.functions.calendar import day_ordinal, month_ordinal, month_start
from admetrics.functions.exact import exact_sum
from admetrics.functions.ratios import divide

_TOTALS = {
    "total_impressions": ("impressions", F.sum),
    "total_clicks": ("clicks", F.sum),
    "total_conversions": ("conversions", F.sum),
    "total_spend": ("spend_usd", exact_sum),
    "total_revenue": ("revenue_usd", exact_sum),
}

# Ratios of the totals above, 0 where the divisor is 0 or missing.
_RATIOS = {
    "ctr": ("total_clicks", "total_impressions"),
    "cpc": ("total_spend", "total_clicks"),
    "conversion_rate": ("total_conversions", "total_clicks"),
    "roas": ("total_revenue", "total_spend"),
    "cost_per_conversion": ("total_spend", "total_conversions"),
    "revenue_per_click": ("total_revenue", "total_clicks"),
}


def _totals():
    return [total(F.col(c)).alias(name) for name, (c, total) in _TOTALS.items()]


def _with_ratios(totals: DataFrame) -> DataFrame:
    return totals.withColumns({name: divide(num, den) for name, (num, den) in _RATIOS.items()})


def kpis(fact: DataFrame, by=()) -> DataFrame:
    """Totals and ratios of totals per group; without ``by`` one row for everything."""
    return _with_ratios(fact.groupBy(*by).agg(*_totals()))


def kpi_contexts(fact: DataFrame, by) -> DataFrame:
    """The measures of every filter context over the columns ``by`` in one pass over the fact.

    ``context`` tells a context from the values of its columns: a bit, the first column's the highest, is set for each column that is
    not part of it, and that column is NULL. A row counts once for each context inside its task, where the sums are combined; one shuffle
    brings these sums together.
    """
    return _with_ratios(fact.cube(*by).agg(*_totals(), F.grouping_id().cast("int").alias("context")))


def kpi_mom(fact: DataFrame, by=(), date="full_date", calendar=None) -> DataFrame:
    """Spend per month and its change from the calendar month before, per group.

    A row exists for each month of the calendar (by default: of any group's rows) in which the group or the
    month before it spent something, so a silent month after a month with spend shows -1. The change is NULL where the month before is
    absent or spent nothing. A month's total is passed on to the month after it: no grid of all groups and months is built.
    """
    monthly = (
        fact.withColumn("_month", month_ordinal(date))
        .groupBy(*by, "_month")
        .agg(exact_sum(F.col("spend_usd")).alias("spend"))
    )
    nothing = F.lit(None).cast("double")
    own = monthly.select(*by, "_month", F.col("spend").alias("total_spend"), nothing.alias("previous_spend"))
    after = monthly.select(*by, (F.col("_month") + 1).alias("_month"), nothing.alias("total_spend"), F.col("spend").alias("previous_spend"))
    days = fact if calendar is None else calendar
    months = days.select(month_ordinal(date).alias("_month"), month_start(date).alias("month")).distinct()
    spent = F.coalesce("total_spend", F.lit(0.0)) - F.col("previous_spend")
    return (
        own.union(after)
        .groupBy(*by, "_month")
        .agg(F.max("total_spend").alias("total_spend"), F.max("previous_spend").alias("previous_spend"))
        .join(months, "_month")
        .select(*by, "month", "total_spend", "previous_spend", (spent / F.nullif(F.col("previous_spend"), F.lit(0.0))).alias("spend_mom"))
    )


def kpi_7d(fact: DataFrame, by=(), date="full_date", days=7, calendar=None) -> DataFrame:
    """Mean of a group's daily impression totals of the last 7 days; days without data do not count.

    A row exists for each day of the calendar (by default: of any group's rows) with data of the group in its 7 days. A
    day's total is passed on to the 6 days after it.
    """
    daily = fact.groupBy(*by, day_ordinal(date).alias("_from")).agg(F.sum("impressions").alias("total"))
    later = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    passed = daily.select(*by, "_from", "total", later.alias("_later")).withColumn("_day", F.col("_from") + F.col("_later"))
    dates = (fact if calendar is None else calendar).select(day_ordinal(date).alias("_day"), F.col(date)).distinct()
    return (
        passed.groupBy(*by, "_day")
        .agg(
            F.max(F.when(F.col("_later") == 0, F.col("total"))).alias("total_impressions"),
            (F.sum("total") / F.nullif(F.count("total"), F.lit(0))).alias("impressions_7d_avg"),
        )
        .join(dates, "_day")
        .select(*by, date, "total_impressions", "impressions_7d_avg")
    )
