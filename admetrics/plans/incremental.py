"""Silver and Gold after new Bronze files, without rebuilding what they leave as it was.

A new event changes the running totals of its campaign from its day on, the rolling averages of its campaign for seven days, and the ranks of its channel's week. So
from the Bronze files that no build has seen yet follow the touched campaigns, weeks and dates; only the Silver partitions of these dates are read, computed and
overwritten. What lies before them is taken from the totals per campaign and day, which are stored beside Silver and grow by the new events' totals.

``silver/log`` says which files a build has seen. An update writes a line before it overwrites anything and another when it is done; an update that finds one
without the other, or files gone that were seen (a batch overwrote them), rebuilds everything.
"""

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admetrics import schemas
from admetrics.functions.calendar import NO_DAY, day_ordinal, parse_date
from admetrics.functions.ratios import metric_columns, with_metrics
from admetrics.operators import quality, windows
from admetrics.operators.ranges import RANGE_ROWS, text_key
from admetrics.session import materialize, shuffles_freed
from admetrics.sinks.writers import rebalanced, write_table
from admetrics.sources.readers import read_table

DAYS, LOG = "silver/days", "silver/log"
_LOG_SCHEMA = "version string, files array<string>, done boolean"
_COMPUTED = [*windows.ROLLING.values(), "running_total_spend", "roas_rank_in_channel"]


def _log(spark, base):
    try:
        return spark.read.schema(_LOG_SCHEMA).parquet(f"{base}/{LOG}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _note(spark, base, version, files, done, mode="append"):
    spark.createDataFrame([(version, files, done)], _LOG_SCHEMA).coalesce(1).write.mode(mode).parquet(f"{base}/{LOG}")


def start_log(spark, base, silver: DataFrame, files) -> None:
    """After a full build: the day totals of all rows, and the files they came from."""
    write_table(windows.day_totals(silver), base, f"{DAYS}/version=all")
    _note(spark, base, "all", sorted(files), True, "overwrite")


def unseen(spark, base, files):
    """The files that no build has seen; None if only a full build can tell what they change."""
    lines = _log(spark, base)
    done = {r.version for r in lines if r.done}
    if not done or done != {r.version for r in lines}:
        return None
    seen = {f for r in lines for f in r.files}
    return sorted(set(files) - seen) if seen <= set(files) else None


def stored_totals(spark, base) -> DataFrame:
    """Day totals of all finished builds; one row per campaign and day."""
    versions = [r.version for r in _log(spark, base) if r.done]
    totals = spark.read.parquet(f"{base}/{DAYS}").where(F.col("version").isin(versions)).drop("version")
    return windows.add_day_totals(totals)


def _keyed(df):
    return df.withColumns({"_campaign": text_key("campaign_id"), "_day": day_ordinal("date"), "_week": F.weekofyear("date")})


def touched_days(new: DataFrame, totals: DataFrame) -> list[int]:
    """The days whose rows new events may change: their own, later ones of their campaigns, and those of their weeks in all years."""
    keyed = _keyed(new)
    firsts = keyed.groupBy("_campaign").agg(F.min("_day").alias("_first"))
    later = totals.select("_campaign", "_day").join(firsts, "_campaign").where(F.col("_day") >= F.col("_first")).select("_day")
    # At most 53 weeks and the row of dates that cannot be read.
    weeks = [r[0] for r in keyed.select("_week").distinct().collect()]
    days = totals.select("_day").distinct()
    date = F.date_from_unix_date(F.col("_day").cast("int"))
    same_week = days.where(F.weekofyear(date).isin([w for w in weeks if w is not None]) & (F.col("_day") != NO_DAY))
    # Days of the calendar.
    return sorted(r[0] for r in later.union(same_week).union(keyed.select("_day")).distinct().collect())


def on_days(df: DataFrame, days, name="date") -> DataFrame:
    """The rows of some days, as a filter on the partition column itself."""
    dates = [F.date_from_unix_date(F.lit(d)) for d in days if d != NO_DAY]
    chosen = F.col(name).isin(dates) if dates else F.lit(False)
    return df.where(chosen | F.col(name).isNull() if NO_DAY in days else chosen)


def changed_rows(old: DataFrame, new: DataFrame, totals: DataFrame, range_rows=RANGE_ROWS) -> DataFrame:
    """Silver rows of the touched days. ``old``: their rows so far; ``new``: the new rows; ``totals``: day totals with the new rows."""
    keyed = _keyed(new)
    firsts = materialize(keyed.groupBy("_campaign").agg(F.min("_day").alias("_first")), "touched-campaigns")
    weeks = materialize(keyed.select(text_key("channel").alias("_channel"), F.coalesce("_week", F.lit(0)).alias("_week")).distinct(), "touched-weeks")
    nothing = {c: F.lit(None).cast(schemas.SILVER[c].dataType) for c in _COMPUTED}
    rows = old.select(*schemas.SILVER.names).unionByName(new.withColumns(nothing).select(*schemas.SILVER.names))
    keys = {"_channel": text_key("channel"), "_week": F.coalesce(F.weekofyear("date"), F.lit(0)), "_campaign": text_key("campaign_id"), "_day": day_ordinal("date")}
    marked = (
        rows.withColumns(keys)
        .join(weeks.withColumn("_ranked", F.lit(True)), ["_channel", "_week"], "left")
        .join(firsts, "_campaign", "left")
        .select(*rows.columns, F.col("_ranked").isNotNull().alias("_rank"), F.coalesce(F.col("_day") >= F.col("_first"), F.lit(False)).alias("_run"))
    )
    marked = materialize(marked, "touched-rows")
    ranked = windows.roas_rank(marked.where("_rank").drop("roas_rank_in_channel"), range_rows=range_rows)
    marked = materialize(marked.where("NOT _rank").unionByName(ranked), "ranked-rows")
    plain = marked.where("_run").drop(*windows.ROLLING.values(), "running_total_spend")
    own = totals.join(firsts.select("_campaign"), "_campaign", "left_semi")
    base = materialize(windows.spend_before(own, firsts), "spend-before")
    running = windows.running_sum(plain, range_rows=range_rows, base=base)
    rolled = windows.join_days(running, windows.rolling_of(own))
    return marked.where("NOT _run").unionByName(rolled).select(*schemas.SILVER.names)


def update_silver(spark, base, name, files, range_rows=RANGE_ROWS, quarantine=None):
    """Brings the Silver table ``name`` up to the new Bronze ``files``: the days that changed, and the days of new events.

    Events that Silver has already on a touched day are replays and are left out. ``quarantine`` takes the malformed rows.
    """
    raw, _ = quality.split_repeated(spark.read.schema(schemas.RAW).parquet(*files))
    if quarantine:
        raw, bad = quality.split_valid(raw)
        bad.write.mode("append").parquet(quarantine)
    new = materialize(with_metrics(parse_date(raw)), "new-events")
    totals = stored_totals(spark, base)
    days = touched_days(new, totals)
    old = on_days(read_table(spark, base, name, schema=schemas.SILVER), days)
    fresh = materialize(new.join(old.select("event_id"), "event_id", "left_anti"), "fresh-events")
    version = hashlib.md5("\n".join(files).encode()).hexdigest()
    _note(spark, base, version, [], False)
    write_table(windows.day_totals(fresh), base, f"{DAYS}/version={version}")
    own = windows.add_day_totals(totals.unionByName(windows.day_totals(fresh)))
    rows = materialize(changed_rows(old, fresh, own, range_rows), "changed-rows")
    gathered = rebalanced(rows, ["platform", "date"], metric_columns())
    with shuffles_freed(spark):
        written = gathered.write.mode("overwrite").options(compression="zstd", partitionOverwriteMode="dynamic")
        written.partitionBy("platform", "date").parquet(f"{base}/{name}")
    own_days = sorted(r[0] for r in _keyed(fresh).select("_day").distinct().collect())
    return days, own_days, version


def finish(spark, base, version, files) -> None:
    _note(spark, base, version, list(files), True)
