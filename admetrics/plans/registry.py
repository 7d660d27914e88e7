"""The registered queries over the test data.

Layers are stored once per session and folder: Bronze from ``lineitem``, Silver from Bronze, the star schema
and the two marts from Silver. Each query reads the layer it belongs to, as the jobs do.
"""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admetrics import schemas
from admetrics.functions import calendar as cal
from admetrics.functions.classify import channel_type, channel_type_lookup
from admetrics.functions.ratios import floor_ratio, null_ratio, pct, with_metrics
from admetrics.operators import kpis, marts, quality, windows
from admetrics.operators.star import fact as fact_of
from admetrics.operators.star import fact_where
from admetrics.plans import incremental, jobs
from admetrics.plans.layers import build_dims, build_silver, build_star, store_silver
from admetrics.session import materialize, new_path, shuffles_freed
from admetrics.sinks import layout, writers
from admetrics.sources import readers
from admetrics.sources.ad_events import ad_events
from admetrics.streaming import streams

_stored = {}
QUERIES = {}


def _once(spark: SparkSession, sf_dir, name, make):
    key = (spark.sparkContext.applicationId, str(sf_dir), name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def bronze(spark, sf_dir) -> DataFrame:
    def make():
        with shuffles_freed(spark):
            return materialize(ad_events(spark, sf_dir), "bronze")

    return _once(spark, sf_dir, "bronze", make)


def silver(spark, sf_dir) -> DataFrame:
    def make():
        with shuffles_freed(spark):
            return materialize(build_silver(bronze(spark, sf_dir)), "silver")

    return _once(spark, sf_dir, "silver", make)


def dims(spark, sf_dir) -> dict:
    def make():
        return {name: materialize(df, name) for name, df in build_dims(silver(spark, sf_dir)).items()}

    return _once(spark, sf_dir, "dims", make)


def star(spark, sf_dir) -> dict:
    def make():
        return {**dims(spark, sf_dir), "fact_ad_impressions": materialize(fact_of(silver(spark, sf_dir), dims(spark, sf_dir)), "fact")}

    return _once(spark, sf_dir, "star", make)


def stored_star(spark, sf_dir) -> str:
    """The folder that holds the star schema's tables by name."""

    def make():
        base = new_path(spark, "gold")
        for name, df in star(spark, sf_dir).items():
            writers.write_table(df, base, name)
        return base

    return _once(spark, sf_dir, "stored_star", make)


def daily_mart(spark, sf_dir) -> DataFrame:
    def make():
        return materialize(marts.campaign_daily(silver(spark, sf_dir), ordered=False), "campaign-daily")

    return _once(spark, sf_dir, "campaign_daily", make)


def weekly_mart(spark, sf_dir) -> DataFrame:
    def make():
        return materialize(marts.channel_weekly(silver(spark, sf_dir), ordered=False), "channel-weekly")

    return _once(spark, sf_dir, "channel_weekly", make)


def metrics(spark, sf_dir) -> DataFrame:
    return with_metrics(bronze(spark, sf_dir))


def wire_events(spark, sf_dir) -> DataFrame:
    """Bronze as it travels: ``date`` is a string."""
    return bronze(spark, sf_dir).withColumn("date", F.col("date").cast("string"))


def flawed_events(spark, sf_dir) -> DataFrame:
    """Wire events with some values spoilt, for the row checks."""
    spoilt = {
        "spend_usd": F.when(F.col("clicks") % 7 == 3, -1 - F.col("spend_usd")),
        "date": F.when(F.col("impressions") % 11 == 5, F.lit("bad")),
        "campaign_type": F.when(F.col("clicks") % 10 == 9, F.lit("other")),
    }
    df = wire_events(spark, sf_dir).withColumns(
        {name: F.coalesce(value, F.col(name)) for name, value in spoilt.items()}
    )
    return df.withColumn("campaign_id", F.when(F.col("conversions") % 13 != 6, F.col("campaign_id")))


def fact_with(spark, sf_dir, *dims) -> DataFrame:
    tables = star(spark, sf_dir)
    keys = {"dim_campaign": "campaign_key", "dim_channel": "channel_key", "dim_date": "date_key"}
    df = tables["fact_ad_impressions"]
    for name in dims:
        df = df.join(tables[name], keys[name])
    return df


def _fact_by_day(spark, sf_dir) -> str:
    base = new_path(spark, "fact-table")
    writers.write_table(star(spark, sf_dir)["fact_ad_impressions"], base, "fact", partition_by=["date_key"])
    return base


def message_files(spark, sf_dir) -> str:
    def make():
        path = new_path(spark, "messages")
        writers.write_messages(writers.to_kafka_messages(wire_events(spark, sf_dir)), path)
        return path

    return _once(spark, sf_dir, "messages", make)


def query(fn):
    """Registers a query under its function's name; a closing underscore only avoids a clash."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def daily_query(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        return fn(daily_mart(spark, sf_dir))

    return query(run)


def weekly_query(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        return fn(weekly_mart(spark, sf_dir))

    return query(run)


# Row-level functions


@query
def ctr_cpc_roas_cvr(spark, sf_dir):
    return metrics(spark, sf_dir).select("event_id", "ctr", "cpc", "roas", "conversion_rate")


@query
def safe_ratios(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "event_id",
        floor_ratio("revenue_usd", "spend_usd").alias("floor_roas"),
        null_ratio("spend_usd", "clicks").alias("null_cpc"),
        pct("clicks", "impressions").alias("ctr_pct"),
    )


@query
def channel_type_(spark, sf_dir):
    return bronze(spark, sf_dir).select("event_id", channel_type("channel").alias("channel_type"))


@query
def channel_type_lookup_(spark, sf_dir):
    named = bronze(spark, sf_dir).select("event_id", F.col("channel").alias("channel_name"))
    return channel_type_lookup(named)


@query
def calendar_attributes(spark, sf_dir):
    days = bronze(spark, sf_dir).select("event_id", "date")
    return cal.calendar(days, "date").select(
        "*", cal.month_label("date").alias("month_label"), cal.day_ordinal("date").alias("day_ordinal")
    )


# Windows and Silver


@query
def rolling_7d(spark, sf_dir):
    rolled = windows.rolling_7d(metrics(spark, sf_dir))
    return rolled.select("event_id", *windows.ROLLING.values())


@query
def rolling_7d_daily_grain(spark, sf_dir):
    days = windows.campaign_days(bronze(spark, sf_dir))
    return days.select(
        "campaign_id",
        F.date_from_unix_date("_day").alias("date"),
        *windows.ROLLING.values(),
    )


@query
def running_spend(spark, sf_dir):
    return windows.running_sum(bronze(spark, sf_dir)).select("event_id", "running_total_spend")


@query
def roas_rank(spark, sf_dir):
    ranked = windows.roas_rank(metrics(spark, sf_dir))
    return ranked.select("event_id", "roas_rank_in_channel")


@query
def roas_rank_iso_year(spark, sf_dir):
    ranked = windows.roas_rank(metrics(spark, sf_dir), iso_year_groups=True)
    return ranked.select("event_id", "roas_rank_in_channel")


@query
def roas_rank_by_values(spark, sf_dir):
    """The rank from counts of the values, in so many ranges that the weeks' values are cut."""
    rows = metrics(spark, sf_dir)
    return windows.rank_by_values(rows, range_rows=max(2, rows.count() // 500)).select("event_id", "roas_rank_in_channel")


@query
def silver_(spark, sf_dir):
    return build_silver(bronze(spark, sf_dir))


@query
def silver_in_ranges(spark, sf_dir):
    """The same in so many ranges that most groups are cut, as they are on large tables."""
    events = bronze(spark, sf_dir)
    return build_silver(events, range_rows=max(2, events.count() // 500))


# Star schema


@query
def dim_campaign(spark, sf_dir):
    return build_dims(silver(spark, sf_dir))["dim_campaign"]


@query
def dim_channel(spark, sf_dir):
    return build_dims(silver(spark, sf_dir))["dim_channel"]


@query
def dim_date(spark, sf_dir):
    return build_dims(silver(spark, sf_dir))["dim_date"]


@query
def fact(spark, sf_dir):
    return build_star(silver(spark, sf_dir), materialize)["fact_ad_impressions"]


def renamed_silver(spark, sf_dir) -> DataFrame:
    """Silver in which campaigns take three names in turn, by quarter, and a third party has some of them in spring."""
    turn = (F.year("date") * 4 + F.quarter("date")) % 3
    agency = (F.col("channel") == "Meta Feed") & (F.quarter("date") == 2)
    return silver(spark, sf_dir).withColumns(
        {
            "campaign_name": F.concat("campaign_name", F.lit(" v"), turn.cast("string")),
            "advertiser": F.when(agency, "Third party").otherwise(F.col("advertiser")),
        }
    )


@query
def dim_campaign_versions(spark, sf_dir):
    return build_dims(renamed_silver(spark, sf_dir), history=True)["dim_campaign"]


@query
def fact_as_of(spark, sf_dir):
    """Each event once, with the attributes that its campaign had on its day."""
    tables = build_star(renamed_silver(spark, sf_dir), materialize, history=True)
    fact_table = tables["fact_ad_impressions"].join(tables["dim_campaign"], "campaign_key")
    return fact_table.select("event_id", *schemas.CAMPAIGN_ATTRIBUTES, "valid_from", "campaign_key", "date_key", "channel_key", "spend_usd")


@query
def dim_campaign_grown(spark, sf_dir):
    """The keys after a second load, which brings new sets of attributes: those of the first load are where they were."""
    base, events = new_path(spark, "grown"), renamed_silver(spark, sf_dir)
    for load in (events.where("date < '1995-07-01'"), events):
        dims = build_dims(load, number=jobs.stored_keys(spark, base))
    return dims["dim_campaign"]


@query
def month_of_advertiser(spark, sf_dir):
    """KPIs of one advertiser in one month, from the stored fact, of which only that month's folders are read."""
    base = _once(spark, sf_dir, "fact_by_day", lambda: _fact_by_day(spark, sf_dir))
    tables = star(spark, sf_dir)
    fact_table = readers.read_table(spark, base, "fact", schema=schemas.FACT)
    chosen = fact_where(fact_table, tables, date="year = 1995 AND month = 3", campaign="advertiser = 'Advertiser 1'")
    return kpis.kpis(chosen.join(tables["dim_campaign"], "campaign_key").join(tables["dim_channel"], "channel_key"), ["campaign_id", "channel_name"])


@query
def star_report(spark, sf_dir):
    tables = star(spark, sf_dir)
    return quality.star_report(tables["fact_ad_impressions"], tables)


@query
def campaign_channel_report(spark, sf_dir):
    tables = star(spark, sf_dir)
    return marts.campaign_channel_report(tables["fact_ad_impressions"], tables)


# Marts


@query
def campaign_daily_summary(spark, sf_dir):
    return marts.campaign_daily(silver(spark, sf_dir))


@query
def channel_weekly_summary(spark, sf_dir):
    return marts.channel_weekly(silver(spark, sf_dir))


@query
def channel_weekly_iso_year(spark, sf_dir):
    return marts.channel_weekly(silver(spark, sf_dir), iso_year_groups=True)


@daily_query
def kpi_totals(daily):
    return marts.kpi_totals(daily)


@daily_query
def roas_by_campaign(daily):
    return marts.roas_by_campaign(daily)


@daily_query
def roas_by_campaign_name(daily):
    return marts.roas_by_campaign(daily, by="campaign_name")


@query
def monthly_roas(spark, sf_dir):
    daily = daily_mart(spark, sf_dir)
    return marts.monthly_roas(daily, dims(spark, sf_dir)["dim_campaign"])


@daily_query
def months(daily):
    return marts.months(daily)


@daily_query
def funnel(daily):
    return marts.funnel(daily)


@daily_query
def daily_spend(daily):
    return marts.daily_spend(daily)


@daily_query
def rolling_7row_spend(daily):
    return windows.rolling_rows(marts.daily_spend(daily))


@weekly_query
def channel_efficiency(weekly):
    return marts.channel_efficiency(weekly)


@weekly_query
def platform_share(weekly):
    return marts.platform_share(weekly)


@weekly_query
def weekly_pivot(weekly):
    return marts.weekly_pivot(weekly, schemas.CHANNELS)


@weekly_query
def weekly_stacked(weekly):
    return marts.weekly_stacked(weekly)


@query
def fact_preview(spark, sf_dir):
    fact_table = star(spark, sf_dir)["fact_ad_impressions"]
    return marts.preview(fact_table.select("event_id", "date_key", "spend_usd"), 5, ["event_id"])


# KPI measures


@query
def kpis_overall(spark, sf_dir):
    return kpis.kpis(fact_with(spark, sf_dir))


@query
def kpis_by_channel(spark, sf_dir):
    return kpis.kpis(fact_with(spark, sf_dir, "dim_channel"), ["channel_name"])


@query
def kpis_by_month(spark, sf_dir):
    return kpis.kpis(fact_with(spark, sf_dir, "dim_date"), ["year", "month"])


@query
def kpis_all_contexts(spark, sf_dir):
    """All measures by any choice of campaign, channel and month, from one scan of the fact."""
    months = fact_with(spark, sf_dir, "dim_campaign", "dim_channel", "dim_date").withColumn("month", cal.month_label("full_date"))
    return kpis.kpi_contexts(months, ["campaign_id", "channel_name", "month"])


@query
def kpi_spend_mom(spark, sf_dir):
    return kpis.kpi_mom(fact_with(spark, sf_dir, "dim_date"), calendar=star(spark, sf_dir)["dim_date"])


@query
def kpi_spend_mom_by_campaign(spark, sf_dir):
    joined = fact_with(spark, sf_dir, "dim_date", "dim_campaign")
    return kpis.kpi_mom(joined, ["campaign_id"], calendar=star(spark, sf_dir)["dim_date"])


@query
def kpi_impressions_7d(spark, sf_dir):
    return kpis.kpi_7d(fact_with(spark, sf_dir, "dim_date"), calendar=star(spark, sf_dir)["dim_date"])


@query
def kpi_impressions_7d_by_channel(spark, sf_dir):
    joined = fact_with(spark, sf_dir, "dim_date", "dim_channel")
    return kpis.kpi_7d(joined, ["channel_name"], calendar=star(spark, sf_dir)["dim_date"])


# Row checks


@query
def valid_events(spark, sf_dir):
    good, _ = quality.split_valid(flawed_events(spark, sf_dir))
    return good


@query
def quarantine(spark, sf_dir):
    _, bad = quality.split_valid(flawed_events(spark, sf_dir), domains=True)
    return bad.select("event_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def benchmark_bands(spark, sf_dir):
    return quality.benchmark_bands(bronze(spark, sf_dir))


# Sources, sinks, layout


@query
def kafka_messages(spark, sf_dir):
    """Key and every field of the JSON value, as the wire has them."""
    messages = writers.to_kafka_messages(wire_events(spark, sf_dir))
    value = F.from_json(F.col("value").cast("string"), "map<string, string>")
    fields = messages.select(F.col("key").cast("string").alias("key"), value.alias("value"))
    return fields.select("key", *[F.element_at("value", f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW])


@query
def kafka_roundtrip(spark, sf_dir):
    return readers.parse_events(writers.to_kafka_messages(wire_events(spark, sf_dir)))


@query
def json_roundtrip(spark, sf_dir):
    path = new_path(spark, "events-json")
    writers.write_events_json(wire_events(spark, sf_dir), path)
    return readers.read_events_json(spark, path)


@query
def csv_roundtrip(spark, sf_dir):
    folder = new_path(spark, "csv")
    path = writers.export_csv(daily_mart(spark, sf_dir), folder, "campaign_daily_summary", compression="gzip")
    return readers.read_mart_csv(spark, path, schemas.CAMPAIGN_DAILY)


@query
def table_roundtrip(spark, sf_dir):
    base = new_path(spark, "tables")
    stored = silver(spark, sf_dir)
    writers.write_table(stored, base, "silver", partition_by=["platform", "channel"])
    return readers.read_table(spark, base, "silver", schema=schemas.SILVER)


@query
def partitioned_silver(spark, sf_dir):
    """Silver written by platform and date, as the batch job stores it."""
    base = new_path(spark, "silver-table")
    writers.write_table(silver(spark, sf_dir), base, "silver", partition_by=["platform", "date"])
    return readers.read_table(spark, base, "silver", schema=schemas.SILVER)


@query
def partitioned_fact(spark, sf_dir):
    """The fact written by date_key, as the batch job stores it."""
    return readers.read_table(spark, _fact_by_day(spark, sf_dir), "fact", schema=schemas.FACT)


@query
def sql_path_table(spark, sf_dir):
    """The whole campaign x channel report in SQL text over stored tables named by their paths."""
    base = stored_star(spark, sf_dir)
    return spark.sql(
        f"""
        WITH per_pair AS (
          SELECT campaign_key, channel_key, SUM(impressions) AS seen, SUM(clicks) AS clicked,
                 SUM(CAST(spend_usd AS DECIMAL(38,18))) AS spent, SUM(CAST(revenue_usd AS DECIMAL(38,18))) AS earned
          FROM parquet.`{base}/fact_ad_impressions` GROUP BY ALL),
        named AS (
          SELECT campaign_name, channel_name, SUM(seen) AS impressions, SUM(clicked) AS clicked,
                 CAST(SUM(spent) AS DOUBLE) AS total_spend, CAST(SUM(earned) AS DOUBLE) AS earned
          FROM per_pair
            JOIN (SELECT campaign_key, campaign_name FROM parquet.`{base}/dim_campaign`) USING (campaign_key)
            JOIN (SELECT channel_key, channel_name FROM parquet.`{base}/dim_channel`) USING (channel_key)
          GROUP BY campaign_name, channel_name)
        SELECT campaign_name, channel_name, impressions,
               CAST(ROUND(CAST(100D * clicked / NULLIF(impressions, 0) AS DECIMAL(38,18)), 2) AS DOUBLE) AS ctr_pct,
               CAST(ROUND(CAST(earned / NULLIF(total_spend, 0D) AS DECIMAL(38,18)), 2) AS DOUBLE) AS roas,
               total_spend
        FROM named ORDER BY total_spend DESC, campaign_name, channel_name
        """
    )


@query
def registered_table(spark, sf_dir):
    """A catalog table over the stored Silver, all platforms; the name is taken anew each time."""
    base = new_path(spark, "registered")
    path = writers.write_table(silver(spark, sf_dir), base, "silver", partition_by=["platform"])
    spark.sql("DROP TABLE IF EXISTS admetrics_silver")
    writers.register_table(spark, "admetrics_silver", path, partitioned=True)
    return spark.table("admetrics_silver").groupBy("platform", "channel").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("impressions").alias("impressions")
    )


@query
def clustered_rewrite(spark, sf_dir):
    fact_table = star(spark, sf_dir)["fact_ad_impressions"]
    path = layout.rewrite_clustered(
        fact_table, ["campaign_key", "date_key"], new_path(spark, "clustered"), spread_by="event_id"
    )
    return spark.read.schema(schemas.FACT).parquet(path)


# Streams


def _run_stream(spark, sf_dir, start):
    base = new_path(spark, "stream")
    messages = readers.read_messages_files(spark, message_files(spark, sf_dir))
    start(messages, f"{base}/table", f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    return base


@query
def stream_silver(spark, sf_dir):
    base = _run_stream(spark, sf_dir, streams.stream_silver)
    layout_of = streams.silver_stream(spark.createDataFrame([], readers.MESSAGES)).schema
    return readers.read_table(spark, base, "table", schema=layout_of)


@query
def stream_bronze_then_silver(spark, sf_dir):
    base = _run_stream(spark, sf_dir, streams.stream_bronze)
    return build_silver(readers.read_table(spark, base, "table", schema=schemas.RAW))


@query
def bronze_batch_and_stream(spark, sf_dir):
    """One Bronze fed by both jobs: some events arrive in the batch, the others as messages."""
    base = new_path(spark, "lake")
    events = wire_events(spark, sf_dir)
    batch = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    writers.write_table(events.where(batch), base, jobs.BRONZE_BATCH)
    path = new_path(spark, "waiting-messages")
    writers.write_messages(writers.to_kafka_messages(events.where(~batch)), path)
    jobs.append_bronze(readers.read_messages_files(spark, path), base)
    return jobs.read_bronze(spark, base)


def _split_events(spark, sf_dir):
    """Wire events in two parts: the late events of some campaigns and channels, and all others."""
    events = wire_events(spark, sf_dir)
    late = F.pmod(F.xxhash64("campaign_id", "channel"), F.lit(40)) == 0
    late = late & (F.col("date") >= "2001-10-01")
    return events.where(~late), events.where(late)


@query
def silver_updated(spark, sf_dir):
    """Silver after an update: some events, and replays of others, arrive as messages once it is built."""
    base = new_path(spark, "updated-lake")
    early, late = _split_events(spark, sf_dir)
    writers.write_table(early, base, jobs.BRONZE_BATCH)
    store_silver(early, base, jobs.SILVER)
    built = readers.read_table(spark, base, jobs.SILVER, schema=schemas.SILVER)
    incremental.start_log(spark, base, built, jobs.bronze_files(spark, base))
    path = new_path(spark, "late-messages")
    replays = early.where((F.col("date") >= "2001-10-01") & (F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0))
    writers.write_messages(writers.to_kafka_messages(late.union(replays)), path)
    jobs.append_bronze(readers.read_messages_files(spark, path), base)
    files = incremental.unseen(spark, base, jobs.bronze_files(spark, base))
    _, _, version = incremental.update_silver(spark, base, jobs.SILVER, files)
    incremental.finish(spark, base, version, files)
    return readers.read_table(spark, base, jobs.SILVER, schema=schemas.SILVER)


@query
def bronze_replayed(spark, sf_dir):
    """Bronze of a stream whose messages came twice, in two runs: each event once."""
    base = new_path(spark, "replayed-lake")
    path = new_path(spark, "replayed-messages")
    messages = writers.to_kafka_messages(wire_events(spark, sf_dir))
    writers.write_messages(messages.union(messages.limit(1000)), path)
    jobs.append_bronze(readers.read_messages_files(spark, path), base)
    writers.write_messages(messages, path, "append")
    jobs.append_bronze(readers.read_messages_files(spark, path), base)
    return jobs.read_bronze(spark, base)


@query
def repeated_events(spark, sf_dir):
    """Ids that occur more than once in Bronze and its replays, and how many rows of each are set aside."""
    events = bronze(spark, sf_dir)
    replays = events.where("clicks % 5 = 1")
    third = events.where("clicks % 15 = 1").withColumn("clicks", F.col("clicks") + 1)
    _, aside = quality.split_repeated(events.union(replays).union(third))
    return aside.select("event_id", "copies", F.array_join("reasons", "; ").alias("reasons"))


@query
def unique_events(spark, sf_dir):
    """The rows that stay: of a repeated id that with the smallest content."""
    events = bronze(spark, sf_dir)
    third = events.where("clicks % 15 = 1").withColumn("timestamp", F.lit("2001-01-01T00:00:00Z"))
    kept, _ = quality.split_repeated(events.union(events.where("clicks % 5 = 1")).union(third))
    return kept
