from datetime import date

import pytest
from pyspark.sql import functions as F

from admetrics.operators import kpis, marts
from admetrics.plans.layers import build_silver, build_star


def test_row_means_and_ratios_of_sums_differ(events):
    silver = build_silver(events({"impressions": 100, "clicks": 10}, {"impressions": 300, "clicks": 3}))
    daily = marts.campaign_daily(silver).first()
    assert daily.avg_ctr == pytest.approx((0.1 + 0.01) / 2, abs=1e-12)
    assert kpis.kpis(silver).first().ctr == 13 / 400


def test_week_one_of_the_next_year(events):
    silver = build_silver(events({"date": "2024-12-30"}, {"date": "2024-01-02"}))
    assert [(r.year, r.week) for r in marts.channel_weekly(silver).collect()] == [(2024, 1)]
    iso = marts.channel_weekly(silver, iso_year_groups=True).collect()
    assert [(r.year, r.week) for r in iso] == [(2024, 1), (2025, 1)]


def test_zero_spend_gives_a_huge_roas(events):
    daily = marts.campaign_daily(build_silver(events({"spend_usd": 0.0, "revenue_usd": 3.0})))
    row = marts.roas_by_campaign(daily).first()
    assert (row.roas, row.tier) == (pytest.approx(3e9), "good")


def test_pivot_finds_or_takes_its_channels(events):
    silver = build_silver(events({}, {"channel": "Audio Spots", "date": "2024-02-01"}))
    weekly = marts.channel_weekly(silver)
    found = marts.weekly_pivot(weekly)
    assert found.columns == ["week", "Audio Spots", "Google Search"]
    assert [tuple(r) for r in found.collect()] == [(1, 0, 100), (5, 100, 0)]
    assert marts.weekly_pivot(weekly, ["Meta Feed"]).first()["Meta Feed"] == 0


def test_stacked_and_funnel(events):
    silver = build_silver(events({}, {"channel": "Meta Feed"}, {"channel": "Meta Stories"}))
    stacked = marts.weekly_stacked(marts.channel_weekly(silver)).collect()
    assert [(r.base, r.top) for r in stacked] == [(0, 100), (100, 200), (200, 300)]
    steps = marts.funnel(marts.campaign_daily(silver)).collect()
    assert [(r.stage, r.value, r.step_rate) for r in steps] == [
        ("Impressions", 300, None),
        ("Clicks", 30, 0.1),
        ("Conversions", 3, 0.1),
    ]


def test_month_over_month_needs_the_month_before(events):
    tables = build_star(
        build_silver(
            events(
                {"date": "2024-01-05", "spend_usd": 0.0},
                {"date": "2024-02-05", "spend_usd": 4.0},
                {"date": "2024-03-05", "spend_usd": 6.0},
                {"date": "2024-05-05", "spend_usd": 6.0},
                {"date": "2024-12-05", "spend_usd": 1.0},
                {"date": "2025-01-05", "spend_usd": 2.0},
            )
        )
    )
    joined = tables["fact_ad_impressions"].join(tables["dim_date"], "date_key")
    got = kpis.kpi_mom(joined).orderBy("month").collect()
    assert [(r.month, r.spend_mom) for r in got] == [
        (date(2024, 1, 1), None),
        (date(2024, 2, 1), None),
        (date(2024, 3, 1), 0.5),
        (date(2024, 5, 1), None),
        (date(2024, 12, 1), None),
        (date(2025, 1, 1), 1.0),
    ]


def test_silent_months_and_days_have_their_measures(events):
    """A silent month after one with spend is -100 %; a silent day still has the mean of its last seven days."""
    silver = build_silver(
        events(
            {"campaign_id": "A", "date": "2024-01-05", "impressions": 10, "spend_usd": 4.0},
            {"campaign_id": "A", "date": "2024-02-05", "impressions": 20, "spend_usd": 2.0},
            {"campaign_id": "B", "date": "2024-01-30", "impressions": 70, "spend_usd": 5.0},
            {"campaign_id": "A", "date": "2024-04-05", "impressions": 30, "spend_usd": 1.0},
        )
    )
    months = kpis.kpi_mom(silver, ["campaign_id"], "date").orderBy("campaign_id", "month").collect()
    assert [(r.campaign_id, str(r.month)[:7], r.total_spend, r.previous_spend, r.spend_mom) for r in months] == [
        ("A", "2024-01", 4.0, None, None),
        ("A", "2024-02", 2.0, 4.0, -0.5),
        ("A", "2024-04", 1.0, None, None),
        ("B", "2024-01", 5.0, None, None),
        ("B", "2024-02", None, 5.0, -1.0),
    ]
    days = kpis.kpi_7d(silver, ["campaign_id"], "date").where("campaign_id = 'B'").orderBy("date").collect()
    assert [(str(r.date), r.total_impressions, r.impressions_7d_avg) for r in days] == [
        ("2024-01-30", 70, 70.0),
        ("2024-02-05", None, 70.0),
    ]


def test_seven_day_mean_counts_days_not_rows(events):
    df = events(
        {"date": "2024-01-01", "impressions": 10},
        {"date": "2024-01-01", "impressions": 20},
        {"date": "2024-01-03", "impressions": 50},
        {"date": "2024-01-08", "impressions": 70},
    )
    got = kpis.kpi_7d(build_silver(df), date="date").orderBy("date").collect()
    assert [r.impressions_7d_avg for r in got] == [30.0, 40.0, 60.0]


def test_divide_gives_zero(events):
    row = kpis.kpis(events({"clicks": 0, "impressions": 0, "conversions": 0, "spend_usd": 0.0})).first()
    assert (row.ctr, row.cpc, row.conversion_rate, row.roas) == (0.0, 0.0, 0.0, 0.0)
    assert (row.cost_per_conversion, row.revenue_per_click) == (0.0, 0.0)


def test_report_sums_names_that_share_keys(events):
    silver = build_silver(events({"campaign_id": "C1"}, {"campaign_id": "C2"}))
    tables = build_star(silver)
    row = marts.campaign_channel_report(tables["fact_ad_impressions"], tables).collect()
    assert [(r.campaign_name, r.impressions, r.ctr_pct, r.roas, r.total_spend) for r in row] == [
        ("One", 200, 10.0, 2.0, 10.0)
    ]


def test_contexts_cost_one_scan_and_one_shuffle(spark, events):
    df = events(*[{"campaign_id": f"C{i % 3}", "channel": None if i % 4 else "Meta Feed", "clicks": i} for i in range(24)])
    found = kpis.kpi_contexts(df, ["campaign_id", "channel"])
    for context, by in ((3, []), (1, ["campaign_id"]), (2, ["channel"]), (0, ["campaign_id", "channel"])):
        want = kpis.kpis(df, by)
        got = found.where(F.col("context") == context).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" in plan
