"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from admetrics import schemas
from admetrics.functions.ratios import metric_columns, with_metrics
from admetrics.operators import kpis, marts, ranges, star, windows
from admetrics.operators.ranges import numbered
from admetrics.plans.layers import build_silver, build_star, silver_by_weeks, store_silver
from admetrics.session import materialize
from admetrics.sinks import layout, writers
from admetrics.sources import readers

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def plan_of(df):
    execution = df._jdf.queryExecution()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return execution.explainString(mode)


def nodes(plan, kind):
    """The input columns of every operator of a kind."""
    return re.findall(rf"^\(\d+\) {kind}.*?\nInput \[\d+\]: (.*?)$", plan, re.M)


@pytest.fixture
def stored(events):
    rows = [{"date": f"2024-01-{1 + i % 28:02d}", "channel": "Meta Feed", "spend_usd": 1.0 + i} for i in range(56)]
    return materialize(events(*rows), "plan-test")


def test_silver_windows_have_one_form(stored, conf):
    """Every window over event rows lies inside a range and costs one shuffle; only what lies before a border is broadcast."""
    conf(**NO_BROADCAST)
    df = numbered(with_metrics(stored.withColumn("date", F.to_date("date"))))
    for made in (windows.running_sum(df, range_rows=10), windows.roas_rank(df, range_rows=10)):
        plan = plan_of(made)
        wide = [c for c in nodes(plan, "Window") if "advertiser" in c]
        assert wide and all("_range" in c for c in wide)
        assert len([c for c in nodes(plan, "Exchange") if "advertiser" in c]) == 1
        assert not [c for c in nodes(plan, "BroadcastExchange") if "event_id" in c]


def test_silver_costs_two_shuffles_and_one_join(stored, conf):
    """Rank and running total deal the rows once each; the third shuffle is that of the rolling averages' join."""
    conf(**NO_BROADCAST)
    plan = plan_of(build_silver(stored, range_rows=10))
    assert len([c for c in nodes(plan, "Exchange") if "advertiser" in c]) == 3
    assert len([c for c in nodes(plan, "Window") if "advertiser" in c]) == 2


def test_tables_before_the_borders_are_smaller_than_the_ranges(spark, stored):
    df = numbered(with_metrics(stored.withColumn("date", F.to_date("date"))))
    running, rank = windows.plan_running(df, range_rows=5), windows.plan_rank(df, range_rows=5)
    assert 1 < running.ranges.count and running.before.count() < running.ranges.count
    assert rank.above.count() < rank.ranges.count and rank.on_border.count() < rank.ranges.count


def test_rolling_averages_join_last(stored, conf):
    """So adaptive execution may split a campaign and day with very many rows."""
    conf(**NO_BROADCAST)
    plan = plan_of(windows.rolling_7d(stored.withColumn("date", F.to_date("date")), most=10))
    assert not [c for c in nodes(plan, "Window") if "advertiser" in c]


def test_fact_joins_stored_dimensions_without_a_shuffle(stored):
    silver = materialize(build_silver(stored), "plan-silver")
    plan = plan_of(build_star(silver, materialize)["fact_ad_impressions"])
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan, re.M)) == 3
    assert not nodes(plan, "Exchange")


def test_a_campaign_with_most_rows_is_split_when_its_dimension_is_large(spark, conf):
    conf(
        **NO_BROADCAST,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    rows = spark.range(0, 60_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.concat(F.lit("C"), F.col("id") % 40)).alias("campaign_id"),
        F.lit("Meta Feed").alias("channel"),
        F.lit("2024-01-01").cast("date").alias("date"),
    )
    rows = materialize(rows, "skewed")
    campaigns = rows.select("campaign_id").distinct().withColumn("campaign_key", F.hash("campaign_id"))
    dims = {
        "dim_campaign": materialize(campaigns, "dim_campaign"),
        "dim_channel": spark.sql("SELECT 'Meta Feed' AS channel_name, 0L AS channel_key"),
        "dim_date": spark.sql("SELECT DATE '2024-01-01' AS full_date, 20240101 AS date_key"),
    }
    keyed = star.attach_keys(rows, dims)
    assert len(keyed.collect()) == 60_000
    assert "skew=true" in keyed._jdf.queryExecution().executedPlan().toString()


def test_marts_read_only_their_columns(stored):
    silver = materialize(build_silver(stored), "plan-silver")
    plan = plan_of(marts.channel_weekly(silver))
    read = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "channel",
        "platform",
        "date",
        "impressions",
        "clicks",
        "spend_usd",
        "revenue_usd",
        "roas",
        "ctr",
    }


def test_measures_combine_before_the_shuffle(stored):
    silver = materialize(build_silver(stored), "plan-silver")
    plan = plan_of(kpis.kpis(silver, ["channel"]))
    assert len(nodes(plan, "HashAggregate")) == 2 and len(nodes(plan, "Exchange")) == 1
    assert "partial_sum" in plan


def test_dimension_keys_use_many_buckets(spark):
    members = spark.range(3000).select(
        *[F.concat(F.lit(c[:10]), F.col("id")).alias(c) for c in schemas.CAMPAIGN_ATTRIBUTES]
    )
    plan = plan_of(star.with_key(members, schemas.CAMPAIGN_ATTRIBUTES, "campaign_key"))
    numbered = [c for c in nodes(plan, "Window") if "campaign_name" in c]
    assert len(numbered) == 1 and "_bucket" in numbered[0]


def test_plain_silver_sends_narrow_rows_and_sorts_them_once(stored, conf):
    """Ratios follow from the row and are worked out behind the shuffles; one order serves the running total and the rolling averages."""
    conf(**NO_BROADCAST)
    plan = plan_of(build_silver(stored))
    sent = [c for c in nodes(plan, "Exchange") if "advertiser" in c]
    assert len(sent) == 2
    for ratio in ("ctr#", "cpc#", "roas#", "conversion_rate#", "_campaign#", "_day#", "_channel#"):
        assert not [c for c in sent if f", {ratio}" in c]
    assert len([c for c in nodes(plan, "Sort") if "advertiser" in c]) == 2
    assert len([c for c in nodes(plan, "Window") if "advertiser" in c]) == 3


@pytest.mark.parametrize("ordered", [False, True])
def test_days_of_small_campaigns_are_summed_behind_one_shuffle(stored, ordered):
    silver = materialize(build_silver(stored), "plan-silver")
    plan = plan_of(marts.campaign_daily(silver, ordered=ordered))
    assert len(nodes(plan, "Exchange")) == 1 and "sum" not in nodes(plan, "Exchange")[0]
    before = plan_of(marts.campaign_daily(silver, ordered=ordered, most=10))
    assert "sum" in nodes(before, "Exchange")[0]
    assert marts.campaign_daily(silver, ordered, most=10).collect() == marts.campaign_daily(silver, ordered).collect() or not ordered


def test_z_order_runs_in_generated_code(spark):
    df = spark.range(50).withColumn("k", (F.col("id") * 7 % 20).cast("double"))
    marks = df.withColumn("m", F.lit([2.0, 5.0, 5.0, 9.0]).cast("array<double>"))
    counted = layout.with_count_up_to(marks, "m", F.col("k"), "n").withColumn("want", layout.count_up_to("m", "k"))
    assert counted.where("n <> want").isEmpty()
    assert "lambdafunction" not in plan_of(layout.with_z_order(df, ["id", "k"]))


def test_silver_in_ranges_stores_and_sends_rows_without_their_ratios(spark, events, monkeypatch):
    """Where weeks are cut and campaigns fit, no ratio or hash is stored or sent, and the rows are those of plain windows."""
    rows = [
        {"campaign_id": f"C{i % 9}", "event_id": f"e{i}", "date": f"2024-01-{1 + i % 3:02d}", "channel": "Meta Feed", "spend_usd": 1.0 + i % 7} for i in range(90)
    ]
    raw, stored = materialize(events(*rows), "plan-test"), []

    def kept(df, name):
        stored.append(df.columns)
        return materialize(df, name)

    monkeypatch.setattr(ranges, "materialize", kept)
    assert windows.campaign_rows(raw.withColumn("date", F.to_date("date"))) == (10, 90)
    cut = build_silver(raw, range_rows=10)
    assert stored == [[*raw.columns, ranges.ROW]]
    sent = [x for x in nodes(plan_of(cut), "Exchange") if "event_id" in x]
    assert len(sent) == 2 and not any(name in x for x in sent for name in ("ctr", "cpc", "roas#", "conversion_rate", "_tie", "_falling", "_row"))
    plain = build_silver(raw)
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, plain.collect()))


def test_tasks_of_plain_windows_follow_the_rows(spark):
    few = spark.range(10).withColumn("campaign_id", F.col("id").cast("string"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert windows.by_campaigns(few, 10).rdd.getNumPartitions() <= tasks
    assert windows.by_campaigns(few, ranges.RANGE_ROWS * tasks + 1).rdd.getNumPartitions() == tasks + 1


@pytest.mark.parametrize("range_rows", [1000, 10])
def test_a_large_silver_is_stored_without_a_third_shuffle(spark, events, tmp_path, range_rows):
    """The rank comes last, in weeks or ranges of them; the rows and the table are those of the other order."""
    rows = [
        {"campaign_id": f"C{i % 9}", "event_id": f"e{i}", "date": f"2024-01-{1 + i % 9:02d}", "channel": f"Meta {i % 2}", "revenue_usd": 1.0 + i % 7} for i in range(90)
    ]
    raw = materialize(events(*rows, {"event_id": None, "campaign_id": None, "date": "bad", "channel": None}), "plan-test")
    made, gathered = silver_by_weeks(raw, range_rows, gathered_from=1)
    assert gathered and not silver_by_weeks(raw, range_rows)[1] and not silver_by_weeks(raw, 5, gathered_from=1)[1]
    sent = [x for x in nodes(plan_of(made), "Exchange") if "event_id" in x]
    assert len(sent) == 2 and not any(name in x for x in sent for name in ("ctr", "cpc", "roas#", "conversion_rate", "_tie", "_falling", "_row"))
    want = sorted(map(repr, build_silver(raw).collect()))
    assert sorted(map(repr, made.collect())) == want
    store_silver(raw, str(tmp_path), "silver", range_rows=range_rows, gathered_from=1)
    assert sorted(map(repr, readers.read_table(spark, str(tmp_path), "silver", schema=schemas.SILVER).collect())) == want


def test_rows_are_sent_packed(stored):
    """The texts of a row go through Silver's shuffles, and through that of a write by day, in one column; ratios are worked out behind the latter."""
    silver = build_silver(stored)
    written = writers.rebalanced(silver, ["platform", "date"], metric_columns())
    wide = [x for x in nodes(plan_of(written), "Exchange") if "event_id" in x]
    assert len(wide) == 3 and not any(f"{name}#" in f" {x}".replace("_timestamp#", "") for x in wide for name in (" advertiser", " event_id", " timestamp"))
    assert "ctr#" not in wide[-1] and "ctr#" not in wide[0]
    assert sorted(map(repr, written.collect())) == sorted(map(repr, silver.collect()))
