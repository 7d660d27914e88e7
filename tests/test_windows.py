import random
from datetime import date, timedelta

import pytest
from conftest import by_id
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_plans import plan_of

from admetrics import schemas
from admetrics.functions.calendar import day_ordinal, parse_date
from admetrics.functions.exact import exact_mean, exact_sum
from admetrics.functions.ratios import with_metrics
from admetrics.operators import marts, windows
from admetrics.operators.ranges import find_ranges, numbered, text_key
from admetrics.plans.layers import build_silver
from admetrics.session import materialize


def skewed_rows(n, seed=7):
    """A third of the rows in one campaign, day and channel, a third with zero roas, some NULLs."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        row = {
            "event_id": f"{rng.random():.12f}-{i}",
            "campaign_id": "C1" if hot else rng.choice(["C2", "C3", "", None]),
            "date": "2024-03-05" if hot else rng.choice(["bad", None, *map(str, _days(40))]),
            "channel": "Meta Feed" if hot else rng.choice([None, "Google Search", "Meta Feed"]),
            "impressions": rng.choice([None, 0, rng.randrange(1000)]),
            "clicks": rng.choice([None, 0, rng.randrange(100)]),
            "spend_usd": rng.choice([None, 0.0, 4.0, rng.randrange(1, 10**6) / 100]),
            "revenue_usd": rng.choice([None, 0.0, 8.0, rng.randrange(10**6) / 100]),
        }
        rows.append(row)
    return rows


def _days(n):
    return [date(2024, 2, 20) + timedelta(days=i) for i in range(n)]


@pytest.fixture
def skewed(events):
    return events(*skewed_rows(1500)).repartition(6)


def plain_silver(raw):
    """The same columns by a window per group, for comparison."""
    df = with_metrics(parse_date(raw)).withColumns({"_c": text_key("campaign_id"), "_d": day_ordinal("date")})
    spend = F.col("spend_usd")
    week = Window.partitionBy(text_key("channel"), F.weekofyear("date")).orderBy(F.desc("roas"))
    so_far = Window.partitionBy("_c").orderBy("_d", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    days = Window.partitionBy("_c").orderBy("_d").rangeBetween(-6, 0)
    rolling = {windows.ROLLING[c]: F.avg(c).over(days) for c in ("impressions", "clicks")}
    return df.withColumns(
        {
            **rolling,
            windows.ROLLING["spend_usd"]: exact_mean(spend, digits=6, window=days),
            "running_total_spend": exact_sum(spend, window=so_far),
            "roas_rank_in_channel": F.rank().over(week).cast("long"),
        }
    ).select(*schemas.SILVER.names)


@pytest.mark.parametrize("range_rows", [60, 400, 10**6])
def test_ranges_equal_plain_windows(skewed, range_rows):
    ranged = build_silver(skewed, range_rows=range_rows)
    plain = plain_silver(skewed)
    assert ranged.columns == plain.columns == schemas.SILVER.names
    assert ranged.count() == plain.count() == 1500
    assert ranged.exceptAll(plain).count() == 0


def test_large_values_are_summed_alike_in_all_ranges(events):
    rows = [{"event_id": f"{i:04d}", "spend_usd": 1e9 + i * 1e-3 + 0.1, "date": f"2024-01-{1 + i % 3:02d}"} for i in range(400)]
    df = events(*rows)
    assert build_silver(df, range_rows=40).exceptAll(plain_silver(df)).count() == 0


def test_no_range_holds_a_hot_group(spark, events):
    """A third malformed, one event_id repeated, one value repeated: ranges stay near their size."""
    malformed = spark.range(3000).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RAW])
    repeated = events({"event_id": "same"}).crossJoin(spark.range(3000)).drop("id")
    rest = events(*[{"revenue_usd": i / 100} for i in range(3000)])
    raw = malformed.union(repeated).union(rest).repartition(5)
    df = numbered(with_metrics(parse_date(raw))).withColumns({"_g": text_key("channel"), "_d": day_ordinal("date"), "_falling": -F.col("roas")})
    for order in (["_d", "event_id"], ["_falling"]):
        sizes = find_ranges(df, ["_g", *order], 9000, 300).number(df).groupBy("_range").count()
        assert sizes.agg(F.max("count")).first()[0] < 600 and sizes.count() > 20
    silver = build_silver(raw, range_rows=300)
    ranks = {r.roas_rank_in_channel for r in silver.where("channel IS NULL").collect()}
    assert ranks == {1} and silver.count() == 9000


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_layout_does_not_change_silver(skewed, conf, partitions):
    want = build_silver(skewed).collect()
    conf(spark__sql__shuffle__partitions=partitions)
    got = build_silver(skewed.repartition(3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_rolling_equals_brute_force(skewed):
    rows = parse_date(skewed).where("date IS NOT NULL AND campaign_id IS NOT NULL").collect()
    got = by_id(windows.rolling_7d(parse_date(skewed)), "rolling_7d_impressions")
    for r in rows[::25]:
        inside = [
            o.impressions
            for o in rows
            if o.campaign_id == r.campaign_id
            and 0 <= (r.date - o.date).days <= 6
            and o.impressions is not None
        ]
        assert got[r.event_id] == (sum(inside) / len(inside) if inside else None)


def test_last_running_total_is_the_campaign_sum(skewed):
    silver = build_silver(skewed, range_rows=100)
    totals = silver.groupBy("campaign_id").agg(
        F.max("running_total_spend").alias("last"), marts.exact_sum(F.col("spend_usd")).alias("total")
    )
    assert totals.where("NOT last <=> total").count() == 0


def test_running_total_breaks_ties_by_event_id(events):
    df = events(
        {"event_id": "b", "spend_usd": 1.0},
        {"event_id": "a", "spend_usd": 2.0},
        {"event_id": "c", "spend_usd": 4.0},
        {"event_id": "z", "spend_usd": 8.0, "date": "2023-12-31"},
    )
    got = by_id(build_silver(df), "running_total_spend", "rolling_7d_spend")
    assert got == {"z": (8.0, 8.0), "a": (10.0, 3.75), "b": (11.0, 3.75), "c": (15.0, 3.75)}


def test_rank_leaves_gaps(events):
    df = events({"revenue_usd": 10.0}, {"revenue_usd": 10.0}, {"revenue_usd": 5.0}, {"revenue_usd": None})
    assert by_id(build_silver(df), "roas_rank_in_channel") == {"e0": 1, "e1": 1, "e2": 3, "e3": 4}


def test_range_edge(events):
    df = events(
        {"date": "2024-01-01", "impressions": 10},
        {"date": "2024-01-07", "impressions": 20},
        {"date": "2024-01-08", "impressions": 40},
    )
    assert by_id(build_silver(df), "rolling_7d_impressions") == {"e0": 10.0, "e1": 15.0, "e2": 30.0}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seven_days_across_a_clock_change(events, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    days = [date(2024, 10, 28) + timedelta(days=i) for i in range(16)]
    df = events(*[{"date": str(d), "impressions": 2**i} for i, d in enumerate(days)])
    got = by_id(build_silver(df), "rolling_7d_impressions")
    for i in range(6, 16):
        assert got[f"e{i}"] == sum(2**j for j in range(i - 6, i + 1)) / 7


def test_weeks_of_two_years_share_a_rank_group(events):
    df = with_metrics(
        parse_date(
            events(
                {"date": "2024-12-30", "revenue_usd": 10.0},
                {"date": "2024-01-02", "revenue_usd": 20.0},
            )
        )
    )
    assert by_id(windows.roas_rank(df), "roas_rank_in_channel") == {"e0": 2, "e1": 1}
    split = windows.roas_rank(df, iso_year_groups=True)
    assert by_id(split, "roas_rank_in_channel") == {"e0": 1, "e1": 1}


def test_row_window_waits_for_seven_rows(spark):
    rows = [("a", date(2024, 1, 1) + timedelta(days=2 * i), float(i)) for i in range(9)]
    rows += [("b", date(2024, 1, 1) + timedelta(days=i), 1.0) for i in range(5)]
    daily = spark.createDataFrame(rows, "campaign_id string, date date, total_spend double")
    got = windows.rolling_rows(daily).orderBy("campaign_id", "date").collect()
    assert [r.rolling_7row_spend for r in got] == [None] * 6 + [3.0, 4.0, 5.0] + [None] * 5


@pytest.mark.parametrize("range_rows", [3, 1000])
def test_rank_by_values_equals_the_window(events, range_rows):
    """A hot week, ties over many ranges, a value with a third of the rows, missing values and channels."""
    rows = [{"date": "2024-01-03", "spend_usd": 1.0, "revenue_usd": float(i % 40) if i % 3 else 0.0} for i in range(150)]
    rows += [{"date": d, "channel": c, "spend_usd": s} for d in ("2024-02-01", "2025-02-01", "bad") for c in ("Meta Feed", None) for s in (1.0, 2.0, None)]
    df = with_metrics(events(*rows).withColumn("date", F.try_to_date("date")))
    df = df.withColumn("roas", F.when(F.col("clicks") > 0, F.when(F.rand(7) < 0.05, F.lit(float("nan"))).otherwise(F.col("roas"))))
    df = materialize(df.withColumn("roas", F.when(F.rand(8) > 0.04, F.col("roas"))), "ranked")
    for iso in (False, True):
        want = by_id(windows.rank_in_weeks(df, iso), "roas_rank_in_channel")
        assert by_id(windows.rank_by_values(df, iso, range_rows), "roas_rank_in_channel") == want and len(want) == 168
        assert by_id(windows.roas_rank(df, iso, range_rows=range_rows), "roas_rank_in_channel") == want
    assert windows.rank_by_values(df.limit(0)).count() == 0


def test_a_row_finds_its_range_without_converting_its_key_again(spark):
    """Border and key have one type, though some fields of the key are never NULL; the ranges follow the order of the keys."""
    df = numbered(spark.range(300).select(F.concat(F.lit("C"), F.lpad((F.col("id") % 7).cast("string"), 3, "0")).alias("c"), "id"))
    keyed = df.withColumn("_c", text_key("c"))
    cut = find_ranges(keyed, ["_c", "id"], 300, 20).number(keyed)
    comparisons = [line for line in plan_of(cut).splitlines() if line.startswith("Output") and "<=" in line]
    assert len(comparisons) > 3 and not [line for line in comparisons if "cast(_key" in line or "as struct<" in line]
    found = [r._range for r in cut.orderBy("_c", "id").collect()]
    assert found == sorted(found) and len(set(found)) > 10
