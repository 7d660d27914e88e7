"""Updates equal full builds, read only what changed, and leave replays out."""

import random

import pytest
from pyspark.sql import functions as F

from admetrics import schemas
from admetrics.operators import quality
from admetrics.plans import incremental, jobs
from admetrics.sinks import writers
from admetrics.sources import readers

TABLES = {jobs.SILVER: schemas.SILVER, **{f"gold/{n}": s for n, s in jobs.GOLD.items()}}


def drawn(ids, dates, seed, campaigns=("C1", "C2", "C3")):
    rng = random.Random(seed)
    return [
        {
            "event_id": i,
            "campaign_id": rng.choice(campaigns),
            "date": rng.choice(dates),
            "channel": rng.choice(["Google Search", "Meta Feed"]),
            "clicks": rng.choice([0, 5, 9]),
            "spend_usd": rng.choice([0.0, 4.0, rng.randrange(1, 10**5) / 100]),
            "revenue_usd": rng.randrange(10**5) / 100,
        }
        for i in ids
    ]


EARLY = [f"2024-01-{d:02d}" for d in range(1, 31)]
LATE = ["2024-01-29", "2024-01-31", "2024-02-02"]


def lake(spark, events, tmp_path, name, *steps, update):
    """Builds from the first rows as the batch, then appends the others as messages, one run each."""
    base, sent = str(tmp_path / name), tmp_path / f"{name}-sent"
    writers.write_table(events(*steps[0]).repartition(2), base, jobs.BRONZE_BATCH)
    jobs.run_silver_and_gold(spark, base)
    for rows in steps[1:]:
        writers.to_kafka_messages(events(*rows)).write.mode("append").parquet(str(sent))
        jobs.run_bronze_then_batch(spark, readers.read_messages_files(spark, str(sent)), base, update=update)
    return base


def contents(spark, base):
    return {name: sorted(map(repr, readers.read_table(spark, base, name, schema=s).collect())) for name, s in TABLES.items()}


@pytest.mark.parametrize("late, campaigns", [(LATE, ("C1", "C3")), (["2024-01-03", "bad", None], ("C2",)), (LATE, ("C1", "C9"))])
def test_update_equals_full_build(spark, events, tmp_path, late, campaigns):
    """Late and old dates, dates that cannot be read, and a new campaign, which moves the keys."""
    first = drawn([f"e{i}" for i in range(120)], [*EARLY, "bad"], 1)
    second = [*drawn([f"n{i}" for i in range(9)], late, 2, campaigns), *first[:7]]
    third = drawn(["z1", "z2"], late, 3, campaigns)
    updated, built = (lake(spark, events, tmp_path, n, first, second, third, update=u) for n, u in (("a", True), ("b", False)))
    assert contents(spark, updated) == contents(spark, built)
    assert readers.read_table(spark, updated, jobs.SILVER).count() == 131
    assert jobs.run_update(spark, updated) == "nothing"


def test_update_reads_and_writes_the_touched_days_alone(spark, events, tmp_path):
    first = drawn([f"e{i}" for i in range(60)], EARLY, 4)
    base = lake(spark, events, tmp_path, "a", first, update=False)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "a" / jobs.SILVER).rglob("*.parquet")}
    new = events(*[{"event_id": "n1", "date": "2024-01-29", "campaign_id": "C1"}])
    writers.write_table(new, base, jobs.BRONZE_STREAM)
    totals = incremental.stored_totals(spark, base)
    days = incremental.touched_days(new.withColumn("date", F.to_date("date")), totals)
    assert days and min(days) >= 19751  # Monday, 2024-01-29
    old = incremental.on_days(readers.read_table(spark, base, jobs.SILVER, schema=schemas.SILVER), days)
    filters = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date" in filters and old.select("date").distinct().count() <= 2
    assert jobs.run_update(spark, base) == "part"
    same = [p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]]
    gone = {p.parent.name for p in before if not p.exists()}
    assert gone <= {"date=2024-01-29", "date=2024-01-30"} and len(same) >= len(before) - 4


def test_an_update_that_was_cut_short_is_followed_by_a_full_build(spark, events, tmp_path):
    first = drawn([f"e{i}" for i in range(30)], EARLY, 5)
    base = lake(spark, events, tmp_path, "a", first, update=False)
    writers.write_table(events(*drawn(["n1"], LATE, 6)).coalesce(1), base, jobs.BRONZE_STREAM)
    files = incremental.unseen(spark, base, jobs.bronze_files(spark, base))
    assert len(files) == 1
    incremental.update_silver(spark, base, jobs.SILVER, files)
    assert incremental.unseen(spark, base, files) is None
    assert jobs.run_update(spark, base) == "full" and jobs.run_update(spark, base) == "nothing"
    assert readers.read_table(spark, base, jobs.SILVER).count() == 31
    # A batch that replaces its files leaves no way but a full build.
    writers.write_table(events(*first[:5]), base, jobs.BRONZE_BATCH)
    assert jobs.run_update(spark, base) == "full"
    assert readers.read_table(spark, base, jobs.SILVER).count() == 6


def test_ranges_give_the_same_update(spark, events, tmp_path):
    first = drawn([f"e{i}" for i in range(200)], EARLY, 7, ("C1", None))
    new = drawn([f"n{i}" for i in range(20)], ["2024-01-12"], 8, ("C1",))
    base = lake(spark, events, tmp_path, "a", first, update=False)
    writers.write_table(events(*new), base, jobs.BRONZE_STREAM)
    incremental.update_silver(spark, base, jobs.SILVER, incremental.unseen(spark, base, jobs.bronze_files(spark, base)), range_rows=15)
    built = lake(spark, events, tmp_path, "b", [*first, *new], update=False)
    got, want = (readers.read_table(spark, b, jobs.SILVER, schema=schemas.SILVER) for b in (base, built))
    assert got.count() == 220 and got.exceptAll(want).count() == 0


def test_a_replayed_message_is_stored_once(spark, events, tmp_path):
    """In one run, after a restart, and when the event is in the batch too."""
    base, sent = str(tmp_path / "lake"), str(tmp_path / "sent")
    writers.write_table(events({"event_id": "b"}, {"event_id": "both"}), base, jobs.BRONZE_BATCH)

    def send(*ids):
        writers.to_kafka_messages(events(*[{"event_id": i} for i in ids])).write.mode("append").parquet(sent)
        jobs.run_bronze_then_batch(spark, readers.read_messages_files(spark, sent), base)
        stored = readers.read_table(spark, base, jobs.BRONZE_STREAM).select("event_id").collect()
        return sorted((r.event_id or "-" for r in stored)), readers.read_table(spark, base, jobs.SILVER).count()

    assert send("a", "a", "both", None, None) == (["-", "-", "a", "both"], 5)
    assert send("a", "c", None) == (["-", "-", "-", "a", "both", "c"], 7)


def test_repeated_ids_keep_the_smallest_row(spark, events):
    rows = [{"event_id": "a", "clicks": 3}, {"event_id": "a", "clicks": 1}, {"event_id": "a", "clicks": 1}, {"event_id": None}, {"event_id": None}, {"event_id": "b"}]
    hot = [{"event_id": "hot", "clicks": i % 7} for i in range(300)]
    kept, aside = quality.split_repeated(events(*rows, *hot).repartition(4))
    assert sorted((r.event_id or "-", r.clicks) for r in kept.collect()) == [("-", 10), ("-", 10), ("a", 1), ("b", 10), ("hot", 0)]
    assert {(r.event_id, r.copies) for r in aside.collect()} == {("a", 2), ("hot", 299)}
    empty, none = quality.split_repeated(events().limit(0))
    assert empty.count() == none.count() == 0


def test_many_repeated_ids_are_dealt_once(events):
    """Both forms keep the same rows; the dealt one sends whole rows through one shuffle."""
    rows = [{"event_id": f"e{i % 20}", "clicks": i} for i in range(60)] + [{"event_id": None}] * 3 + [{"event_id": "once"}]
    df = events(*rows)
    (dealt, aside), (joined, as_before) = quality.split_repeated(df, few=5), quality.split_repeated(df)
    assert sorted(dealt.collect(), key=str) == sorted(joined.collect(), key=str) and dealt.count() == 24
    assert sorted(aside.collect()) == sorted(as_before.collect())
    plan = dealt.select("*")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    hot, _ = quality.split_repeated(df, few=5, most=2)
    assert "Join" in hot._jdf.queryExecution().executedPlan().toString()
