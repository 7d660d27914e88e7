"""Times the headline queries and prints one JSON line.

Bronze is stored first (its time is listed too); every query then runs from its stored input layer to a
sink that takes all rows and writes none. Each figure is the median of the runs after one warm-up.

`python bench.py --plain` times the plain forms of the same work instead, as a yardstick: a window per campaign or channel and week, which puts
each group into one task, and sums of doubles, whose last bits depend on the layout.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from admetrics.functions.ratios import with_metrics
from admetrics.operators import kpis, marts, windows
from admetrics.plans import registry
from admetrics.plans.layers import build_silver, build_star
from admetrics.schemas import CAMPAIGN_ATTRIBUTES
from admetrics.session import get_session, materialize
from admetrics.sources.ad_events import ad_events

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def plain_queries(spark, bronze, silver, fact, tables, by_channel, by_date):
    """The same results but for the last bits, in the simplest Spark form."""
    days = Window.partitionBy("campaign_id").orderBy(F.unix_date("date")).rangeBetween(-6, 0)
    so_far = Window.partitionBy("campaign_id").orderBy("date", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    week = Window.partitionBy("channel", F.weekofyear("date")).orderBy(F.desc("roas"))
    rolling = {name: F.avg(c).over(days) for c, name in windows.ROLLING.items()}
    running = {"running_total_spend": F.sum("spend_usd").over(so_far)}
    rank = {"roas_rank_in_channel": F.rank().over(week)}
    rows = with_metrics(bronze)
    sums = [F.sum(c).alias(c) for c in ("impressions", "clicks", "spend_usd", "revenue_usd")]
    means = [F.avg("ctr").alias("ctr"), F.avg("roas").alias("roas")]
    weekly = silver.groupBy("channel", "platform", F.year("date"), F.weekofyear("date"))
    pair = fact.groupBy("campaign_key", "channel_key").agg(*sums)
    named = pair.join(tables["dim_campaign"], "campaign_key").join(tables["dim_channel"], "channel_key")
    monthly = by_date.groupBy("year", "month").agg(F.sum("spend_usd").alias("spend"))
    daily = by_date.groupBy("full_date").agg(F.sum("impressions").alias("n"))
    by_month = Window.orderBy("year", "month")
    week_before = Window.orderBy(F.unix_date("full_date")).rangeBetween(-6, 0)
    return {
        "bronze": lambda: ad_events(spark, SF_DIR),
        "silver": lambda: rows.withColumns({**rolling, **running, **rank}),
        "rolling_7d": lambda: rows.withColumns(rolling),
        "running_spend": lambda: rows.withColumns(running),
        "roas_rank": lambda: rows.withColumns(rank),
        "fact": lambda: build_star(silver, materialize)["fact_ad_impressions"],
        "campaign_daily_summary": lambda: silver.groupBy(*CAMPAIGN_ATTRIBUTES, "date").agg(*sums, *means).orderBy("campaign_id", "date"),
        "channel_weekly_summary": lambda: weekly.agg(*sums, *means),
        "campaign_channel_report": lambda: named.groupBy("campaign_name", "channel_name").agg(*sums).orderBy("spend_usd"),
        "kpis_by_channel": lambda: by_channel.groupBy("channel_name").agg(*sums),
        "kpis_by_month": lambda: by_date.groupBy("year", "month").agg(*sums),
        "kpi_spend_mom": lambda: monthly.withColumn("before", F.lag("spend").over(by_month)),
        "kpi_impressions_7d": lambda: daily.withColumn("mean", F.avg("n").over(week_before)),
    }


def main():
    spark = get_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    bronze = registry.bronze(spark, SF_DIR)
    silver = registry.silver(spark, SF_DIR)
    tables = registry.star(spark, SF_DIR)
    fact = tables["fact_ad_impressions"]
    by_channel = fact.join(tables["dim_channel"], "channel_key")
    by_date = fact.join(tables["dim_date"], "date_key")
    rows = with_metrics(bronze)
    queries = {
        "bronze": lambda: ad_events(spark, SF_DIR),
        "silver": lambda: build_silver(bronze),
        "rolling_7d": lambda: windows.rolling_7d(rows),
        "running_spend": lambda: windows.running_sum(rows),
        "roas_rank": lambda: windows.roas_rank(rows),
        "fact": lambda: build_star(silver, materialize)["fact_ad_impressions"],
        "campaign_daily_summary": lambda: marts.campaign_daily(silver),
        "channel_weekly_summary": lambda: marts.channel_weekly(silver),
        "campaign_channel_report": lambda: marts.campaign_channel_report(fact, tables),
        "kpis_by_channel": lambda: kpis.kpis(by_channel, ["channel_name"]),
        "kpis_by_month": lambda: kpis.kpis(by_date, ["year", "month"]),
        "kpi_spend_mom": lambda: kpis.kpi_mom(by_date),
        "kpi_impressions_7d": lambda: kpis.kpi_7d(by_date),
    }
    if "--plain" in sys.argv:
        queries = plain_queries(spark, bronze, silver, fact, tables, by_channel, by_date)
    seconds = {}
    for name, make in queries.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            consume(make())
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    total = sum(seconds.values())
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
            }
        )
    )


if __name__ == "__main__":
    main()
