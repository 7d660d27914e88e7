"""Raw events to Silver, Silver to the star schema."""

from pyspark.sql import DataFrame

from admetrics.functions.calendar import parse_date
from admetrics.functions.ratios import metric_columns, with_metrics
from admetrics.operators import star, windows
from admetrics.operators.history import dim_campaign_versions
from admetrics.operators.keys import with_key
from admetrics.operators.ranges import OWN, RANGE_ROWS, numbered
from admetrics.schemas import SILVER
from admetrics.sinks.writers import write_table


def build_silver(raw: DataFrame, range_rows=RANGE_ROWS) -> DataFrame:
    """Ratios, rolling averages, running total and rank on every raw row.

    Where a campaign, or a channel's week, has more than ``range_rows`` rows, the rows are stored once, with their numbers, and cut into
    ranges. Rank and running total cost one shuffle each either way. The ratios are worked out behind each shuffle instead of being stored or
    going through it: they follow from the row, and doubles without a pattern are what compresses least.
    """
    events = parse_date(raw)
    rows = with_metrics(events)
    largest, n = windows.campaign_rows(rows)
    campaigns_fit, weeks_fit = largest <= range_rows, windows.weeks_fit(rows, most=range_rows)
    if not (campaigns_fit and weeks_fit):
        events = numbered(events)
    # What the running total needs of a row besides its content where it is put together from ranges.
    kept = [c for c in events.columns if c not in OWN or not campaigns_fit]
    if weeks_fit:
        ranked = windows.rank_in_weeks(with_metrics(windows.by_weeks(events.select(*kept), rows=n))).drop(*metric_columns())
    else:
        ranked = windows.add_rank(events, windows.plan_rank(with_metrics(events), count=n, range_rows=range_rows), with_metrics, kept)
    if campaigns_fit:
        return windows.in_campaigns(with_metrics(windows.by_campaigns(ranked, n))).select(*SILVER.names)
    running = windows.add_running(ranked, windows.plan_running(events, n, range_rows))
    return with_metrics(windows.join_days(running, windows.campaign_days(events))).select(*SILVER.names)


#: Rows from which Silver is stored without a shuffle by day: a file for each channel and day is no small one then.
GATHERED_FROM = 10_000_000


def silver_by_weeks(raw: DataFrame, range_rows=RANGE_ROWS, gathered_from=GATHERED_FROM) -> tuple[DataFrame, bool]:
    """The rows of `build_silver`, and whether those of a day lie in few tasks.

    In a large table whose campaigns fit into tasks the rank comes last, so the rows of a channel's week, or a range of them, end up in one task: a table by day
    needs no third shuffle. A row's range is found before the first shuffle, as it is a smaller column than the tie-break.
    """
    events = parse_date(raw)
    rows = with_metrics(events)
    largest, n = windows.campaign_rows(rows)
    if largest > range_rows or n < gathered_from:
        return build_silver(raw, range_rows), False
    if windows.weeks_fit(rows, most=range_rows):
        summed = windows.in_campaigns(with_metrics(windows.by_campaigns(events, n))).drop(*metric_columns())
        ranked = windows.rank_in_weeks(with_metrics(windows.by_weeks(summed, rows=n)))
    else:
        given = numbered(events)
        plan = windows.plan_rank(with_metrics(given), count=n, range_rows=range_rows)
        ranged = windows.in_ranges(given, plan, with_metrics).drop(*OWN)
        summed = windows.in_campaigns(with_metrics(windows.by_campaigns(ranged, n))).drop(*metric_columns())
        ranked = with_metrics(windows.add_rank(summed, plan, with_metrics))
    return ranked.select(*SILVER.names), True


def store_silver(raw: DataFrame, base, name, fmt="parquet", range_rows=RANGE_ROWS, gathered_from=GATHERED_FROM) -> None:
    """Silver as a table by platform and date."""
    rows, gathered = silver_by_weeks(raw, range_rows, gathered_from)
    write_table(rows, base, name, fmt, ["platform", "date"], None if gathered else metric_columns(), gathered)


def build_dims(silver: DataFrame, latest=False, history=False, number=with_key) -> dict:
    """The dimensions; with ``history`` campaigns have a row for each version. ``number`` gives the surrogate keys."""
    campaigns = dim_campaign_versions(silver, number) if history else star.dim_campaign(silver, latest, number)
    return {
        "dim_campaign": campaigns,
        "dim_channel": star.dim_channel(silver, latest, number),
        "dim_date": star.dim_date(silver),
    }


def build_star(silver: DataFrame, store=None, latest=False, history=False, number=with_key) -> dict:
    """The three dimensions and the fact.

    ``store(df, name)`` writes a dimension and returns it as read back. The fact then joins the stored
    keys, and Spark knows the size of each dimension before it plans the joins.
    """
    dims = build_dims(silver, latest, history, number)
    if store:
        dims = {name: store(df, name) for name, df in dims.items()}
    return {**dims, "fact_ad_impressions": star.fact(silver, dims)}
