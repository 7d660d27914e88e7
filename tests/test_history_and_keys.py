"""Versions of campaigns, the as-of join to them, keys that stay, and filters through the dimensions."""

import random

import pytest
from pyspark.sql import functions as F
from test_incremental import EARLY, contents, drawn, lake
from test_plans import plan_of

from admetrics import schemas
from admetrics.operators import history, kpis, star
from admetrics.plans import jobs
from admetrics.plans.layers import build_dims, build_silver, build_star
from admetrics.session import materialize
from admetrics.sinks import writers
from admetrics.sources import readers


def dated(events, *rows):
    return events(*rows).withColumn("date", F.try_to_date("date"))


def spans(df):
    rows = df.select("campaign_id", "campaign_name", "valid_from", "valid_to").collect()
    return sorted(((r[0], r[1], str(r[2]), r[3] and str(r[3])) for r in rows), key=repr)


def test_versions_of_a_campaign(events):
    """A name that comes back is a new version; the last event of a day, then the greatest content, names the day."""
    rows = [
        {"campaign_name": "A", "date": "2024-01-01"},
        {"campaign_name": "A", "date": "2024-01-02"},
        {"campaign_name": "B", "date": "2024-01-05"},
        {"campaign_name": "A", "date": "2024-01-07"},
        {"campaign_name": "Z", "date": "2024-01-07", "timestamp": "2023-12-31T00:00:00Z"},
        {"campaign_name": None, "date": "2024-01-09"},
        {"campaign_name": None, "date": "2024-01-10"},
        {"campaign_name": "lost", "date": "bad"},
        {"campaign_id": None, "campaign_name": "lost"},
        {"campaign_id": "C2", "campaign_name": "B"},
        {"campaign_id": "C2", "campaign_name": "C"},
    ]
    made = history.dim_campaign_versions(dated(events, *rows))
    assert made.columns == schemas.DIM_CAMPAIGN_VERSIONS.names
    assert spans(made) == [
        ("C1", "A", "2024-01-01", "2024-01-05"),
        ("C1", "A", "2024-01-07", "2024-01-09"),
        ("C1", "B", "2024-01-05", "2024-01-07"),
        ("C1", None, "2024-01-09", None),
        ("C2", "C", "2024-01-01", None),
    ]
    assert sorted(r.campaign_key for r in made.collect()) == list(range(5))
    assert history.dim_campaign_versions(dated(events).limit(0)).count() == 0


def test_as_of_equals_brute_force(spark, events):
    """Days before the first version take the first; a hot campaign with many versions doubles nothing."""
    rng = random.Random(5)
    days = [f"2024-{m:02d}-{d:02d}" for m in (1, 2, 3) for d in range(1, 29)]
    versions = [(c, d, i) for i, (c, d) in enumerate((c, d) for c in ("C1", "C2") for d in rng.sample(days[3:], 30))]
    table = spark.createDataFrame(versions, "campaign_id string, valid_from string, campaign_key bigint").withColumn("valid_from", F.to_date("valid_from"))
    rows = [{"campaign_id": rng.choice(["C1", "C1", "C1", "C2", "C3", None]), "date": rng.choice([*days, "bad"])} for _ in range(400)]
    found = {r.event_id: r.campaign_key for r in history.as_of(dated(events, *rows), table).collect()}
    want = {}
    for i, row in enumerate(rows):
        known = sorted((d, k) for c, d, k in versions if c == row["campaign_id"])
        if known and row["date"] != "bad":
            want[f"e{i}"] = ([k for d, k in known if d <= row["date"]] or [known[0][1]])[-1]
    assert found == want and history.as_of(dated(events, *rows), table).count() == len(want)


def test_as_of_reads_no_frame_again_for_every_row(events):
    """No frame runs from the row to the campaign's end: it would cost the square of the days."""
    df = materialize(dated(events, *[{"date": d} for d in EARLY]), "as-of")
    plan = plan_of(history.as_of(df, materialize(history.dim_campaign_versions(df), "versions")))
    assert "specifiedwindowframe" in plan and "currentrow$(), unboundedfollowing$()" not in plan


def test_as_of_meets_one_row_a_day(events, conf):
    """The event rows are joined by campaign and day, never by campaign alone, and no window sees them."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    df = materialize(dated(events, *[{"date": d} for d in EARLY]), "as-of")
    plan = plan_of(history.as_of(df, materialize(history.dim_campaign_versions(df), "versions")))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("SortMergeJoin") and "Left keys [2]: [campaign_id" in plan
    assert not [line for line in plan.splitlines() if line.startswith("Input") and "_asked" in line and "event_id" in line]


def test_star_with_history_keeps_each_event_once(events):
    rows = [{"campaign_name": n, "date": f"2024-01-0{i + 1}"} for i, n in enumerate("ABAB")]
    silver = build_silver(events(*rows, {"date": "bad"}))
    tables = build_star(silver, materialize, history=True)
    named = tables["fact_ad_impressions"].join(tables["dim_campaign"], "campaign_key")
    assert {r.event_id: r.campaign_name for r in named.collect()} == {f"e{i}": n for i, n in enumerate("ABAB")}
    assert tables["fact_ad_impressions"].columns == schemas.FACT.names and named.count() == 4
    assert kpis.kpis(named).first().total_impressions == 400


def test_batch_job_with_history(spark, events, tmp_path):
    rows = [{"campaign_name": n, "date": f"2024-01-0{i + 1}"} for i, n in enumerate("ABA")]
    writers.write_events_json(events(*rows), str(tmp_path / "in"))
    base = str(tmp_path / "lake")
    jobs.run_batch(spark, str(tmp_path / "in"), base, history=True, keep_keys=True)
    report = jobs.run_validate(spark, base)
    assert report["fact rows"] == 3 and report["repeated campaign_id"] == 1 and report["facts without campaign"] == 0
    whole = readers.read_table(spark, base, "gold/dim_campaign", schema=schemas.DIM_CAMPAIGN_VERSIONS)
    assert len(spans(whole)) == 3
    for flags in (["--latest"], ["--update"]):
        with pytest.raises(SystemExit):
            jobs.parse_arguments(["bronze", "--base", "b", "--servers", "s", "--topic", "t", "--history", *flags])


def keys_of(df):
    return {tuple(r[c] for c in schemas.CAMPAIGN_ATTRIBUTES): r.campaign_key for r in df.collect()}


def test_keys_stay_when_members_come_and_go(spark, events, tmp_path):
    """Inserted members follow the last key; a member that was gone has its key again; missing attributes are values."""

    def load(names):
        rows = [{"campaign_id": f"C{n}", "campaign_name": None if n == 3 else f"N{n}"} for n in names]
        dims = build_dims(dated(events, *rows), number=jobs.stored_keys(spark, str(tmp_path)))
        return keys_of(dims["dim_campaign"])

    first = load(range(0, 200, 2))
    assert sorted(first.values()) == list(range(100))
    grown = load([*range(200), *range(200)])
    assert {m: grown[m] for m in first} == first and sorted(grown.values()) == list(range(200))
    assert load(range(200)) == grown
    fewer = load([3, 7, 500])
    assert {m: k for m, k in fewer.items() if m in grown} == {m: grown[m] for m in fewer if m in grown} and max(fewer.values()) == 200
    assert load([]) == {} and load(range(200)) == grown


def test_first_keys_are_those_of_a_plain_build(spark, events, tmp_path):
    df = dated(events, *[{"campaign_id": f"C{i}"} for i in range(50)])
    kept = build_dims(df, number=jobs.stored_keys(spark, str(tmp_path)))
    assert keys_of(kept["dim_campaign"]) == keys_of(star.dim_campaign(df))


def _spelled(spark, base):
    """The fact with its members in place of their keys."""
    tables = {name: jobs.read_gold(spark, base, name) for name in jobs.DIMS}
    fact = jobs.read_gold(spark, base, "fact_ad_impressions")
    for name, key in (("dim_campaign", "campaign_key"), ("dim_channel", "channel_key")):
        fact = fact.join(tables[name], key).drop(key)
    return sorted(map(repr, fact.collect()))


@pytest.mark.parametrize("renamed", [False, True])
def test_update_with_keys_that_stay(spark, events, tmp_path, renamed):
    """A new campaign no longer rebuilds Gold; a new name of a known campaign does, as it meets all rows of the campaign."""
    first = drawn([f"e{i}" for i in range(60)], EARLY, 1)
    new = [{"event_id": "n1", "campaign_id": "C1" if renamed else "C9", "campaign_name": "Other", "date": "2024-01-29", "channel": "Meta Feed"}]
    base = str(tmp_path / "a")
    writers.write_table(events(*first), base, jobs.BRONZE_BATCH)
    jobs.run_silver_and_gold(spark, base, keep_keys=True)
    old = keys_of(jobs.read_gold(spark, base, "dim_campaign"))
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "a/gold/fact_ad_impressions").rglob("*.parquet")}
    writers.write_table(events(*new), base, jobs.BRONZE_STREAM)
    assert jobs.run_update(spark, base, keep_keys=True) == "part"
    grown = keys_of(jobs.read_gold(spark, base, "dim_campaign"))
    assert {m: grown[m] for m in old} == old and len(grown) == len(old) + 1
    untouched = [p for p in files if p.exists() and p.stat().st_mtime_ns == files[p]]
    assert bool(untouched) != renamed
    built = lake(spark, events, tmp_path, "b", [*first, *new], update=False)
    assert _spelled(spark, base) == _spelled(spark, built)
    marts = [f"gold/{n}" for n in ("campaign_daily_summary", "channel_weekly_summary", "dim_date")]
    assert all(contents(spark, base)[m] == contents(spark, built)[m] for m in marts)


def test_filters_through_dimensions_read_the_days_alone(spark, events, tmp_path, conf):
    """Files of other months are spoilt, so a scan that opened one would fail."""
    rows = [{"campaign_id": f"C{i % 5}", "advertiser": "AB"[i % 5 % 2], "date": f"2024-{1 + i % 6:02d}-{1 + i % 28:02d}"} for i in range(240)]
    tables = build_star(build_silver(events(*rows)), materialize)
    writers.write_table(tables["fact_ad_impressions"], str(tmp_path), "fact", partition_by=["date_key"])
    for path in tmp_path.glob("fact/date_key=*/*.parquet"):
        if not path.parent.name.startswith("date_key=202403"):
            path.write_bytes(b"spoilt")
            path.with_name(f".{path.name}.crc").write_bytes(b"")
    fact = readers.read_table(spark, str(tmp_path), "fact", schema=schemas.FACT)
    conf(
        spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="0",
        spark__sql__optimizer__runtime__bloomFilter__enabled="true",
    )
    chosen = star.fact_where(fact, tables, date="year = 2024 AND month = 3", campaign="advertiser = 'A'")
    assert "dynamicpruning" in plan_of(chosen)
    want = {f"e{i}" for i, r in enumerate(rows) if r["advertiser"] == "A" and r["date"][5:7] == "03"}
    assert {r.event_id for r in chosen.collect()} == want and want
    assert star.fact_where(fact, tables, date="year = 2030").count() == 0
    # Where the campaigns are too many to be sent whole, a bloom filter of their keys meets the scan.
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    assert "might_contain" in plan_of(star.fact_where(fact, tables, campaign="advertiser = 'A'"))
