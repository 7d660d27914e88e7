"""Rolling, running and ranking columns of Silver.

A window per campaign, or per channel and week, puts each group into one task. That is the cheapest way while the groups are small, so their
sizes are counted first. Where the largest has more rows than a range (`ranges.py`), the rolling averages come from day
totals, and the running total and the rank from ranges of the sort key, so that one campaign, day
or channel with a third of all rows spreads over the cluster. Each of the two costs one shuffle of the rows: a pass over the keys finds
what lies before each range, at most one row per border, which is broadcast to the rows that were dealt to their ranges. Both ways give the same rows.
"""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admetrics.functions.calendar import day_ordinal, iso_year
from admetrics.functions.exact import (
    MONEY,
    PARTS,
    add_parts,
    as_double,
    exact_mean,
    money_parts,
    sum_parts,
    total_parts,
)
from admetrics.operators.packing import send_packed
from admetrics.operators.ranges import OWN, RANGE_ROWS, ROW, TIE, Ranges, find_ranges, numbered, text_key

ROLLING = {
    "impressions": "rolling_7d_impressions",
    "clicks": "rolling_7d_clicks",
    "spend_usd": "rolling_7d_spend",
}
_COUNTS = ["impressions", "clicks"]


def _named(parts, prefix):
    return [value.alias(f"{prefix}_{name}") for name, value in parts.items()]


def _stored(prefix):
    return {name: F.col(f"{prefix}_{name}") for name in PARTS}


def _days(n):
    return Window.partitionBy("_campaign").orderBy("_day").rangeBetween(1 - n, 0)


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"_campaign": text_key("campaign_id"), "_day": day_ordinal("date")})


def _with_id(totals: DataFrame) -> DataFrame:
    """Adds the campaign's id, which its key holds and so need not be sent beside it."""
    return totals.select(F.when(F.col("_campaign") != "", F.substr("_campaign", F.lit(2))).alias("campaign_id"), *totals.columns)


def day_totals(df: DataFrame) -> DataFrame:
    """Per campaign and day the sums and counts that the rolling averages are made of; totals of several tables add up."""
    totals = (
        _keyed(df)
        .groupBy("_campaign", "_day")
        .agg(
            *[F.sum(c).alias(f"_{c}") for c in _COUNTS],
            *[F.count(c).alias(f"_n_{c}") for c in ROLLING],
            *_named(total_parts(F.col("spend_usd")), "_spend"),
        )
    )
    return _with_id(totals)


def add_day_totals(totals: DataFrame) -> DataFrame:
    """One row per campaign and day from the day totals of several tables."""
    sums = [F.sum(f"_{c}").alias(f"_{c}") for c in _COUNTS] + [F.sum(f"_n_{c}").alias(f"_n_{c}") for c in ROLLING]
    spend = [F.sum(f"_spend_{name}").cast(kind).alias(f"_spend_{name}") for name, kind in PARTS.items()]
    return _with_id(totals.groupBy("_campaign", "_day").agg(*sums, *spend))


def rolling_of(totals: DataFrame, days=7) -> DataFrame:
    """The rolling averages of each campaign and day from the day totals."""
    frame = _days(days)

    def average(total, name):
        return total / F.nullif(F.sum(f"_n_{name}").over(frame), F.lit(0))

    spend = as_double(sum_parts(_stored("_spend"), frame))
    return totals.select(
        "campaign_id",
        "_campaign",
        "_day",
        *[average(F.sum(f"_{c}").over(frame), c).alias(ROLLING[c]) for c in _COUNTS],
        average(spend, "spend_usd").alias(ROLLING["spend_usd"]),
    )


def campaign_days(df: DataFrame, days=7) -> DataFrame:
    """Per campaign and day: the rolling averages over event rows.

    A RANGE frame takes in every row of its days, so day totals give the same averages as the rows do.
    The frame grows with campaigns x days, not with events.
    """
    return rolling_of(day_totals(df), days)


def spend_before(totals: DataFrame, firsts: DataFrame) -> DataFrame:
    """Per campaign of ``firsts`` (_campaign, _first) the parts of its spend before the day ``_first``."""
    earlier = totals.join(firsts, "_campaign").where(F.col("_day") < F.col("_first"))
    return earlier.groupBy("_campaign").agg(*[F.sum(f"_spend_{name}").cast(kind).alias(f"_base_{name}") for name, kind in PARTS.items()])


def join_days(df: DataFrame, per_day: DataFrame) -> DataFrame:
    """Adds the rolling averages of its campaign and day to every row.

    The join comes last, so adaptive execution may split a campaign and day with very many rows.
    """
    joined = _keyed(df).join(per_day.drop("campaign_id"), ["_campaign", "_day"], "left")
    return joined.select(*df.columns, *ROLLING.values())


def _fit(keyed: DataFrame, keys, most) -> bool:
    """Whether no group has more than ``most`` rows."""
    return keyed.groupBy(*keys).count().where(F.col("count") > most).isEmpty()


def campaign_rows(df: DataFrame) -> tuple[int, int]:
    """The rows of the largest campaign, and of all."""
    sizes = _keyed(df).groupBy("_campaign").count()
    largest, rows = sizes.agg(F.max("count"), F.sum("count")).first()
    return largest or 0, rows or 0


def campaigns_fit(df: DataFrame, most=RANGE_ROWS) -> bool:
    return _fit(_keyed(df), ["_campaign"], most)


def weeks_fit(df: DataFrame, iso_year_groups=False, most=RANGE_ROWS) -> bool:
    keyed, group = _rank_keyed(df, iso_year_groups)
    return _fit(keyed, group, most)


def _dealt(df: DataFrame, rows, beside, *keys) -> DataFrame:
    """Rows with equal keys in one task, in more tasks than the session has for a shuffle where these would get more than ``RANGE_ROWS`` rows each.

    ``beside``: the text column that the keys are made of.
    """
    tasks = math.ceil((rows or 0) / RANGE_ROWS)
    number = [tasks] if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    return send_packed(df, lambda packed: packed.repartition(*number, *keys), [beside])


def by_campaigns(df: DataFrame, rows=None) -> DataFrame:
    """The rows of a campaign in one task, as `in_campaigns` needs them. What follows from a row alone is best added behind this shuffle."""
    return _dealt(df, rows, "campaign_id", "campaign_id")


def in_campaigns(df: DataFrame, rolling=True, running=True, days=7, base=None) -> DataFrame:
    """The rolling averages and the running total by windows over campaigns that fit into a task.

    The rows are sorted once: the order of the running total is also one by day, as the rolling averages need it. The exact parts of the spend are worked
    out once a row, not once for each frame that it lies in.
    """
    content = [F.col(f"`{c}`") for c in df.columns if c not in (*OWN, "_range")]
    frame = Window.partitionBy("campaign_id").orderBy("_day").rangeBetween(1 - days, 0)
    columns = {}
    out = df.withColumn("_day", day_ordinal("date")) if base is None else _keyed(df).join(base, "_campaign", "left")
    out = out.select("*", *_named(money_parts(F.col("spend_usd")), "_spend"))
    if running:
        # Rows with equal content get the same totals in either order.
        so_far = Window.partitionBy("campaign_id").orderBy("_day", "event_id", F.xxhash64(*content))
        parts = sum_parts(_stored("_spend"), so_far.rowsBetween(Window.unboundedPreceding, 0))
        total = as_double(parts) if base is None else as_double(add_parts(_stored("_base"), parts))
        out = out.withColumn("running_total_spend", total)
    if rolling:
        columns |= {ROLLING[c]: F.avg(c).over(frame) for c in _COUNTS}
        n = F.count("spend_usd").over(frame)
        columns[ROLLING["spend_usd"]] = as_double(sum_parts(_stored("_spend"), frame)) / F.nullif(n, F.lit(0))
    added = [*columns, *(["running_total_spend"] if running else [])]
    return out.withColumns(columns).select(*df.columns, *added)


def rolling_7d(df: DataFrame, days=7, most=RANGE_ROWS) -> DataFrame:
    """Adds the rolling averages over the last 7 days, from day totals where a campaign is large."""
    if campaigns_fit(df, most):
        return in_campaigns(df, running=False, days=days)
    return join_days(df, campaign_days(df, days))


def _small(df: DataFrame) -> DataFrame:
    """A table of fewer rows than there are ranges, worked out once and held by the driver."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@dataclass
class RunningPlan:
    """Ranges by campaign, day and event, and the spend of a range's first campaign in earlier ranges."""

    ranges: Ranges
    before: DataFrame


def plan_running(rows: DataFrame, count=None, range_rows=RANGE_ROWS) -> RunningPlan:
    keyed = _keyed(rows)
    ranges = find_ranges(keyed, ["_campaign", "_day", "event_id"], rows.count() if count is None else count, range_rows)
    earlier = Window.partitionBy("_campaign").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and campaign in it.
    sums = ranges.number(keyed).groupBy("_range", "_campaign").agg(*_named(total_parts(F.col("spend_usd")), "_sum"))
    before = sums.select("_range", "_campaign", F.count(F.lit(1)).over(earlier).alias("_n"), *_named(sum_parts(_stored("_sum"), earlier), "_before"))
    return RunningPlan(ranges, _small(before.where("_n > 0").drop("_n")))


def add_running(df: DataFrame, plan: RunningPlan, base=None) -> DataFrame:
    """Adds ``running_total_spend`` to rows with a tie-break: that of the row's range so far, plus its campaign's spend in earlier ranges.

    ``base`` holds what campaigns spent before these rows (`spend_before`).
    """
    here = (
        Window.partitionBy("_range", "_campaign")
        .orderBy("_day", "event_id", TIE, ROW)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    dealt = plan.ranges.dealt(_keyed(df)).select("*", *_named(total_parts(F.col("spend_usd"), here), "_here"))
    # Only the first campaign of a range reaches back, so there are fewer rows than ranges.
    joined = dealt.join(F.broadcast(plan.before), ["_range", "_campaign"], "left")
    parts = [_stored("_before"), _stored("_here")]
    if base is not None:
        joined, parts = joined.join(base, "_campaign", "left"), [_stored("_base"), *parts]
    running = as_double(add_parts(*parts))
    return joined.select(*df.columns, running.alias("running_total_spend"))


def running_sum(df: DataFrame, rows=None, range_rows=RANGE_ROWS, base=None) -> DataFrame:
    """Adds ``running_total_spend`` of each campaign by day; ties within a day follow ``event_id``, then the row's content."""
    if campaigns_fit(df, range_rows):
        return in_campaigns(df, rolling=False, base=base).select(*df.columns, "running_total_spend")
    given = numbered(df)
    return add_running(given, plan_running(given, rows, range_rows), base).select(*df.columns, "running_total_spend")


@dataclass
class RankPlan:
    """Ranges by group and falling roas; a group's rows in earlier ranges; the rows above each value that lies on a border."""

    ranges: Ranges
    group: list
    above: DataFrame
    on_border: DataFrame


def _rank_keyed(df, iso_year_groups):
    keys = {"_channel": text_key("channel"), "_week": F.coalesce(F.weekofyear("date"), F.lit(0))}
    if iso_year_groups:
        keys["_year"] = F.coalesce(iso_year("date"), F.lit(0))
    # Falling roas: NaN first and NULL last, as Spark orders them.
    odd = F.when(F.col("roas").isNull(), 2).when(F.isnan("roas"), 0).otherwise(1)
    return df.withColumns({**keys, "_last": odd, "_falling": F.when(~F.isnan("roas"), -F.col("roas"))}), list(keys)


def plan_rank(rows: DataFrame, iso_year_groups=False, count=None, range_rows=RANGE_ROWS) -> RankPlan:
    keyed, group = _rank_keyed(rows, iso_year_groups)
    value = ["_last", "_falling"]
    ranges = find_ranges(keyed, [*group, *value], rows.count() if count is None else count, range_rows)
    border = {f: ranges.upper_border(f) for f in (*group, *value)}
    same = F.lit(True)
    for f in group:
        same = same & (F.col(f) == border[f])
    before_border = same & (F.struct(*value) < F.struct(*[border[f].alias(f) for f in value]))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and group in it; those that matter are the ones that a border cuts.
    sums = ranges.number(keyed).groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_n"), F.count_if(before_border).alias("_better"))
    sums = sums.withColumn("_above", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    at_border = sums.withColumns({"_cut": F.coalesce(same, F.lit(False)), **{f: border[f] for f in value}})
    cut = _small(at_border.where("_cut OR _above > 0"))
    # A value on several borders has its first row below the first of them.
    on_border = cut.where("_cut").groupBy(*group, *value).agg(F.min(F.col("_above") + F.col("_better")).alias("_above_value"))
    return RankPlan(ranges, group, cut.where("_above > 0").select("_range", *group, "_above"), _small(on_border))


def in_ranges(df: DataFrame, plan: RankPlan, derive=None) -> DataFrame:
    """Adds the ``_range`` of the rank to rows with a tie-break; ``derive`` is that of `add_rank`."""
    keyed, _ = _rank_keyed(derive(df) if derive else df, "_year" in plan.group)
    return plan.ranges.number(keyed).select(*df.columns, "_range")


def add_rank(df: DataFrame, plan: RankPlan, derive=None, kept=None) -> DataFrame:
    """Adds ``roas_rank_in_channel`` to rows with a tie-break.

    Rows that have their ``_range`` already need no tie-break any more. Only the columns ``kept`` (by default all) go through the shuffle. ``derive`` adds ``roas`` to rows that lack it, before the shuffle and again behind it. A row's rank is its rank within its range plus the group's rows in earlier ranges; rows whose value lies on a border, and so may begin in an earlier
    range, take the rank of the value's first row.
    """
    group, kept = plan.group, kept or [c for c in df.columns if c != "_range"]

    def keyed(rows):
        return _rank_keyed(derive(rows) if derive else rows, "_year" in group)[0]

    here = F.rank().over(Window.partitionBy("_range", *group).orderBy("_last", "_falling"))
    ranged = df if "_range" in df.columns else in_ranges(df, plan, derive)
    dealt = keyed(plan.ranges.deal(ranged.select(*kept, "_range"))).withColumn("_here", here)
    # Both tables have fewer rows than there are ranges.
    border = plan.on_border.select(*group, F.col("_last").alias("_b_last"), F.col("_falling").alias("_b_falling"), "_above_value")
    alike = [dealt[g] == border[g] for g in group] + [dealt["_last"] == border["_b_last"], dealt["_falling"].eqNullSafe(border["_b_falling"])]
    joined = dealt.join(F.broadcast(border), alike, "left").drop(*[border[g] for g in group])
    joined = joined.join(F.broadcast(plan.above), ["_range", *group], "left")
    rank = F.coalesce(F.col("_above_value") + 1, F.coalesce("_above", F.lit(0)) + F.col("_here"))
    return joined.select(*kept, rank.cast("long").alias("roas_rank_in_channel"))


def _week_group(iso_year_groups):
    week = [F.col("channel"), F.coalesce(F.weekofyear("date"), F.lit(0))]
    return [*week, F.coalesce(iso_year("date"), F.lit(0))] if iso_year_groups else week


def by_weeks(df: DataFrame, iso_year_groups=False, rows=None) -> DataFrame:
    """The rows of a channel and week in one task, as `rank_in_weeks` needs them, sent without any column of their own for it."""
    return _dealt(df, rows, "channel", *_week_group(iso_year_groups))


def rank_in_weeks(df: DataFrame, iso_year_groups=False) -> DataFrame:
    """The rank by a window over channels and weeks that fit into a task."""
    rank = F.rank().over(Window.partitionBy(*_week_group(iso_year_groups)).orderBy(F.desc("roas")))
    return df.select(*df.columns, rank.cast("long").alias("roas_rank_in_channel"))


def roas_rank(df: DataFrame, iso_year_groups=False, rows=None, range_rows=RANGE_ROWS) -> DataFrame:
    """Adds ``roas_rank_in_channel``: rank by roas, best first, within channel and ISO week.

    Without ``iso_year_groups`` equal weeks of different years share a group.
    """
    if weeks_fit(df, iso_year_groups, range_rows):
        return rank_in_weeks(df, iso_year_groups)
    given = numbered(df)
    return add_rank(given, plan_rank(given, iso_year_groups, rows, range_rows)).select(*df.columns, "roas_rank_in_channel")


def value_ranks(df: DataFrame, iso_year_groups=False, range_rows=RANGE_ROWS) -> DataFrame:
    """The rank of each distinct (group, roas): one more than the rows of the group with a better one.

    Rows are only counted by value, map-side first; what is put in order are the values, in ranges where a group has more than ``range_rows`` of them.
    """
    keyed, group = _rank_keyed(df, iso_year_groups)
    value = ["_last", "_falling"]
    counts = numbered(keyed.groupBy(*group, *value).agg(F.count(F.lit(1)).alias("_n")))
    better = Window.partitionBy(*group).orderBy(*value).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("_n").over(better), F.lit(0)) + 1
    if _fit(counts, group, range_rows):
        return counts.select(*group, *value, rank.alias("_rank"))
    ranges = find_ranges(counts, [*group, *value], counts.count(), range_rows)
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and group in it; those with rows before them are the first groups of their ranges, fewer than there are ranges.
    sums = ranges.number(counts).groupBy("_range", *group).agg(F.sum("_n").alias("_n"))
    above = _small(sums.select("_range", *group, F.sum("_n").over(earlier).alias("_above")).where("_above > 0"))
    here = Window.partitionBy("_range", *group).orderBy(*value).rowsBetween(Window.unboundedPreceding, -1)
    dealt = ranges.dealt(counts).withColumn("_here", F.coalesce(F.sum("_n").over(here), F.lit(0)))
    joined = dealt.join(F.broadcast(above), ["_range", *group], "left")
    return joined.select(*group, *value, (F.coalesce("_above", F.lit(0)) + F.col("_here") + 1).alias("_rank"))


def rank_by_values(df: DataFrame, iso_year_groups=False, range_rows=RANGE_ROWS) -> DataFrame:
    """Adds ``roas_rank_in_channel`` from the ranks of the values; event rows are neither sorted nor gathered by group.

    Pays where values repeat. The table of values is joined without a hint: a small one is broadcast and the rows stay where they are, a
    large one meets them by group and value, and adaptive execution splits a value that very many rows have.
    """
    keyed, group = _rank_keyed(df, iso_year_groups)
    ranks = value_ranks(df, iso_year_groups, range_rows).select(*[F.col(c).alias(f"v{c}") for c in [*group, "_last", "_falling"]], "_rank")
    alike = [F.col(c) == F.col(f"v{c}") for c in [*group, "_last"]] + [F.col("_falling").eqNullSafe(F.col("v_falling"))]
    # Every row has its value in the table.
    return keyed.join(ranks, alike).select(*df.columns, F.col("_rank").cast("long").alias("roas_rank_in_channel"))


def rolling_rows(daily: DataFrame, n=7) -> DataFrame:
    """Mean of the last ``n`` daily spends of a campaign by row; NULL until ``n`` rows exist."""
    rows = Window.partitionBy("campaign_id").orderBy("date").rowsBetween(1 - n, 0)
    full = F.count("total_spend").over(rows) == n
    mean = exact_mean(F.col("total_spend"), MONEY, rows)
    return daily.withColumn(f"rolling_{n}row_spend", F.when(full, mean))
