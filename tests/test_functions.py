import random
from datetime import date
from decimal import Decimal
from fractions import Fraction

import pytest
from conftest import by_id
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from admetrics.functions import calendar, classify, ratios
from admetrics.functions.exact import RATIO, exact_mean, exact_sum
from admetrics.operators.ranges import text_key
from admetrics.sinks.layout import count_up_to


def test_guards_give_zero(events):
    df = ratios.with_metrics(
        events(
            {"impressions": 0, "clicks": 0, "spend_usd": 0.0, "revenue_usd": 3.0},
            {"impressions": None},
            {},
        )
    )
    got = by_id(df, "ctr", "cpc", "roas", "conversion_rate")
    assert got["e0"] == (0.0, 0.0, 0.0, 0.0)
    assert got["e1"] == (0.0, 0.5, 2.0, 0.1)
    assert got["e2"] == (0.1, 0.5, 2.0, 0.1)


def test_floor_null_and_percent_ratios(events):
    df = events({"spend_usd": 0.0, "revenue_usd": 3.0, "impressions": 0}, {"impressions": 3, "clicks": 1})
    df = df.select(
        "event_id",
        ratios.floor_ratio("revenue_usd", "spend_usd").alias("floor"),
        ratios.null_ratio("revenue_usd", "spend_usd").alias("null"),
        ratios.pct("clicks", "impressions").alias("pct"),
        ratios.divide("revenue_usd", "spend_usd").alias("divide"),
    )
    got = by_id(df, "floor", "null", "pct", "divide")
    assert got["e0"] == (pytest.approx(3e9), None, None, 0.0)
    assert got["e1"] == (2.0, 2.0, 33.33, 2.0)


def test_bad_dates_become_null(events):
    df = calendar.parse_date(events({"date": "bad"}, {"date": None}, {"date": "2024-02-29"}))
    assert by_id(df, "date") == {"e0": None, "e1": None, "e2": date(2024, 2, 29)}


def test_calendar(spark):
    df = spark.sql("SELECT DATE '2024-12-30' AS date")
    row = calendar.calendar(df).select("*", calendar.iso_year("date").alias("iso_year")).first()
    assert row.asDict() == {
        "date": date(2024, 12, 30),
        "year": 2024,
        "quarter": 4,
        "month": 12,
        "week": 1,
        "day": 30,
        "day_of_week": "Monday",
        "is_weekend": False,
        "date_key": 20241230,
        "iso_year": 2025,
    }


def test_channel_types(spark):
    names = ["Google Search", "Google Display", "Meta Feed", "Meta Stories", "Audio Spots"]
    df = spark.createDataFrame([(n,) for n in names], "channel_name string")
    by_part = df.select(classify.channel_type("channel_name")).collect()
    by_name = classify.channel_type_lookup(df).select("channel_type").collect()
    assert [r[0] for r in by_part] == ["search", "display", "social_feed", "social_story", "social_story"]
    assert [r[0] for r in by_name] == ["search", "display", "social_feed", "social_story", None]


def test_tiers_and_scaling(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.5), (3, 1.0), (4, None)], "id int, x double")
    tiers = df.orderBy("id").select(classify.roas_tier("x")).collect()
    assert [r[0] for r in tiers] == ["good", "fair", "poor", "poor"]
    sizes = df.orderBy("id").select(classify.scale_to_max("x").alias("s")).collect()
    assert [r.s for r in sizes] == [680.0, 530.0, 380.0, None]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e8, 1e8).map(lambda x: round(x, 2)), min_size=1, max_size=40))
def test_sums_do_not_depend_on_layout(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    results = {
        tuple(df.repartition(n).agg(exact_sum(F.col("x")), exact_mean(F.col("x"), 6)).first())
        for n in (1, 7)
    }
    assert len(results) == 1
    cents = sum(round(v * 100) for v in values)
    assert results.pop()[0] == cents / 100


def test_sums_of_odd_values(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(exact_sum(F.col("x")).alias("s")).first().s

    assert total(None) is None
    assert total(1e300, 1.0) == 1e300
    assert total(5e9, 0.25) == 5e9 + 0.25
    assert total(float("inf"), 1.0) == float("inf")
    assert total(float("nan"), 1.0) != total(1.0)
    assert total(-0.75, None, 0.5) == -0.25


def test_means_keep_small_values(spark):
    df = spark.createDataFrame([(1 / 3,), (1e-7,)], "x double")
    assert df.agg(exact_mean(F.col("x")).alias("m")).first().m == pytest.approx((1 / 3 + 1e-7) / 2, abs=1e-17)


def _drawn(kind, rng):
    if kind == "any":
        return 10 ** rng.uniform(-7, 15) * rng.choice([1, -1])
    if kind == "cents":
        return rng.randrange(10**9) / 100
    if kind == "tiny":
        return 1e-7
    if kind == "large":
        return rng.uniform(1e9, 1e15)
    return rng.choice([0.1, 1e-9, 99999999.999999, 1e8, 1e9, 123456789.123456, -0.3, 5e14])


def test_sums_equal_exact_sums_in_every_layout(spark):
    """Values from 1e-7 to 1e15: the total is that of their shortest decimals, rounded once."""
    rng = random.Random(11)
    rows = [(kind, _drawn(kind, rng)) for kind in ("any", "cents", "tiny", "large", "edges") for _ in range(2000)]
    want = {}
    for kind, x in rows:
        want[kind] = want.get(kind, 0) + Fraction(Decimal(repr(x)))
    for n in (1, 2, 5, 8, 13):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, x double").repartition(n)
        sums = df.groupBy("k").agg(exact_sum(F.col("x")).alias("s"), exact_sum(F.col("x"), RATIO).alias("r"))
        got = {r.k: r for r in sums.collect()}
        assert {k: r.s for k, r in got.items()} == {k: float(x) for k, x in want.items()}
        assert {k: r.r for k, r in got.items()} == pytest.approx({k: float(x) for k, x in want.items()}, rel=1e-14)


def test_binary_search(spark):
    df = spark.range(0, 12).withColumn("a", F.lit([2, 5, 5, 9]).cast("array<bigint>"))
    got = [r[0] for r in df.orderBy("id").select(count_up_to("a", "id")).collect()]
    assert got == [sum(x <= i for x in (2, 5, 5, 9)) for i in range(12)]


def test_text_key_keeps_null_apart(spark):
    df = spark.createDataFrame([(None,), ("",), ("=",)], "x string")
    assert df.select(text_key("x")).distinct().count() == 3
