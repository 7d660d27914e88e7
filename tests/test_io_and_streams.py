import json
import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import _DEFAULTS, by_id
from pyspark.sql import functions as F

from admetrics import schemas
from admetrics.operators import marts
from admetrics.operators.packing import pack, unpack
from admetrics.plans import jobs
from admetrics.plans.layers import build_silver
from admetrics.session import shared_dir
from admetrics.sinks import layout, writers
from admetrics.sources import readers
from admetrics.streaming import streams

NOW = {"availableNow": True}


def _lines(path, *rows):
    path.mkdir(exist_ok=True)
    number = len(list(path.iterdir()))
    text = [r if isinstance(r, str) else json.dumps({**_DEFAULTS, **r}) for r in rows]
    (path / f"part-{number}.json").write_text("\n".join(text) + "\n")


def test_bad_json_becomes_null(spark, tmp_path):
    bad = json.dumps({"event_id": "z", "impressions": "zz", "clicks": 1.5})
    _lines(tmp_path / "in", {"event_id": "a"}, "not json", bad)
    df = readers.read_events_json(spark, str(tmp_path / "in"))
    assert df.schema == schemas.RAW
    rows = {r.event_id: r for r in df.collect()}
    assert rows["a"].clicks == 10
    assert set(rows[None].asDict().values()) == {None}
    assert (rows["z"].impressions, rows["z"].date) == (None, None)
    silver = {r.event_id: r for r in build_silver(df).collect()}
    assert silver[None].ctr == 0.0


def test_json_round_trip(spark, events, tmp_path):
    df = events({}, {"impressions": None})
    writers.write_events_json(df, str(tmp_path / "out"))
    assert readers.read_events_json(spark, str(tmp_path / "out")).exceptAll(df).count() == 0


def test_partitioned_table_prunes_and_keeps_types(spark, events, tmp_path):
    silver = build_silver(events({}, {"date": "2024-01-02"}, {"platform": "Meta", "channel": "Meta Feed"}))
    writers.write_table(silver, str(tmp_path), "silver", partition_by=["platform", "date"])
    back = readers.read_table(spark, str(tmp_path), "silver", schema=schemas.SILVER)
    assert back.schema == schemas.SILVER
    assert back.exceptAll(silver).count() == 0 and back.count() == 3
    plan = back.where("platform = 'Meta' AND date = DATE '2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(platform" in plan
    narrow = back.select("clicks").where("clicks > 3")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(clicks), GreaterThan(clicks,3)]" in narrow
    assert "ReadSchema: struct<clicks:int>" in narrow


def test_csv_export_is_parallel(spark, events, tmp_path):
    daily = marts.campaign_daily(build_silver(events({}, {"date": "2024-01-02"}))).repartition(2)
    path = writers.export_csv(daily, str(tmp_path), "daily")
    back = readers.read_mart_csv(spark, path, schemas.CAMPAIGN_DAILY)
    assert back.exceptAll(daily).count() == 0 and back.count() == 2
    parts = list(Path(path).glob("*.csv"))
    assert len(parts) == 2 and all(p.read_text().startswith("campaign_id,") for p in parts)


def test_registered_table(spark, events, tmp_path):
    path = writers.write_table(events({}, {"platform": "Meta"}), str(tmp_path), "t", partition_by=["platform"])
    name = "t_" + tmp_path.name.replace("-", "_")
    for _ in range(2):
        writers.register_table(spark, name, path, partitioned=True)
    assert spark.table(name).count() == 2
    assert spark.sql(f"SELECT count(*) FROM parquet.`{path}` WHERE platform = 'Meta'").first()[0] == 1


def test_kafka_options():
    options = readers.kafka_options("h:9093", "events", **jobs.broker_options("secret"))
    assert options["startingOffsets"] == "earliest" and "failOnDataLoss" not in options
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="$ConnectionString" password="secret";' in options["kafka.sasl.jaas.config"]
    assert jobs.broker_options(keep_on_data_loss=True) == {"failOnDataLoss": "false"}


def test_messages_round_trip(events):
    df = events({}, {"campaign_id": None, "spend_usd": 1e8})
    messages = writers.to_kafka_messages(df)
    assert messages.dtypes == [("key", "binary"), ("value", "binary")]
    assert messages.first().key == b"C1#2024-01-01"
    assert readers.parse_events(messages).exceptAll(df).count() == 0


def test_clustered_rewrite(spark, tmp_path):
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("campaign_key"),
        (20240101 + F.floor(F.col("id") / 200)).cast("int").alias("date_key"),
    )
    columns = ["campaign_key", "date_key"]
    path = layout.rewrite_clustered(df, columns, str(tmp_path / "z"), spread_by="event_id", n_ranges=8)
    back = spark.read.parquet(path)
    assert back.exceptAll(df).count() == 0 and back.count() == 4000
    files = back.groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.max("date_key").alias("high"), F.min("date_key").alias("low")
    )
    sizes = files.collect()
    assert len(sizes) == 8 and max(r.n for r in sizes) < 1500
    # A file covers a part of the dates only, so that file statistics can skip it.
    assert sum(r.high - r.low for r in sizes) / len(sizes) < 15


def test_z_value_interleaves_bits(spark):
    z = spark.range(1).select(layout.z_value([F.lit(0b101), F.lit(0b011)]).alias("z")).first().z
    assert z == 0b100111


def _send(spark, events, path, *rows):
    writers.to_kafka_messages(events(*rows)).coalesce(1).write.mode("append").parquet(str(path))


def test_stream_restart_adds_only_new_messages(spark, events, tmp_path):
    table, checkpoint, source = (str(tmp_path / n) for n in ("table", "ckpt", "in"))
    columns = streams.silver_stream(spark.createDataFrame([], readers.MESSAGES)).schema

    def run():
        messages = readers.read_messages_files(spark, source)
        streams.stream_silver(messages, table, checkpoint, NOW).awaitTermination()
        return readers.read_table(spark, str(tmp_path), "table", schema=columns)

    _send(spark, events, source, {"event_id": "a"}, {"event_id": "b", "date": "bad", "platform": "Meta"})
    assert by_id(run(), "ctr", "roas")["a"] == (0.1, 2.0)
    assert "conversion_rate" not in columns.names
    assert run().count() == 2
    _send(spark, events, source, {"event_id": "c"})
    assert set(by_id(run(), "ctr")) == {"a", "b", "c"}
    assert {p.name for p in (tmp_path / "table").glob("platform=*")} == {"platform=Google", "platform=Meta"}


def test_stream_then_batch_equals_batch(spark, events, tmp_path):
    rows = [{"event_id": f"e{i}", "date": f"2024-01-{1 + i % 9:02d}", "clicks": i} for i in range(40)]
    source = tmp_path / "in"
    _send(spark, events, source, *rows[:25])
    _send(spark, events, source, *rows[25:])
    base = str(tmp_path / "lake")
    jobs.run_bronze_then_batch(spark, readers.read_messages_files(spark, str(source), 1), base)
    streamed = readers.read_table(spark, base, jobs.SILVER, schema=schemas.SILVER)
    batch = build_silver(events(*rows))
    assert streamed.count() == 40 and streamed.exceptAll(batch).count() == 0


def test_batch_job_and_export(spark, tmp_path):
    source = tmp_path / "in"
    _lines(source, *[{"event_id": f"e{i}", "date": f"2024-01-{1 + i % 4:02d}"} for i in range(8)], "not json")
    base, csv = str(tmp_path / "lake"), str(tmp_path / "csv")
    jobs.run_batch(spark, str(source), base, quarantine=True)
    jobs.run_export(spark, base, csv)
    assert jobs.read_bronze(spark, base).count() == 9
    assert readers.read_table(spark, base, jobs.QUARANTINE).count() == 1
    fact = readers.read_mart_csv(spark, f"{csv}/fact_ad_impressions", schemas.FACT)
    stored = readers.read_table(spark, base, "gold/fact_ad_impressions", schema=schemas.FACT)
    assert fact.exceptAll(stored).count() == 0 and fact.count() == 8
    daily = readers.read_mart_csv(spark, f"{csv}/campaign_daily_summary", schemas.CAMPAIGN_DAILY)
    assert {r.total_spend for r in daily.collect()} == {10.0}


def test_batch_and_stream_share_bronze(spark, events, tmp_path):
    """batch, bronze, batch, bronze: every event is there once in all layers."""
    base, source, sent = str(tmp_path / "lake"), tmp_path / "in", tmp_path / "sent"
    _lines(source, *[{"event_id": f"b{i}", "date": f"2024-01-{1 + i:02d}"} for i in range(5)])

    def layers():
        names = (jobs.SILVER, "gold/fact_ad_impressions")
        tables = [jobs.read_bronze(spark, base), *[readers.read_table(spark, base, name) for name in names]]
        return [sorted(r.event_id for r in t.select("event_id").collect()) for t in tables]

    jobs.run_batch(spark, str(source), base)
    assert layers() == [[f"b{i}" for i in range(5)]] * 3
    _send(spark, events, sent, *[{"event_id": f"s{i}"} for i in range(3)])
    jobs.run_bronze_then_batch(spark, readers.read_messages_files(spark, str(sent)), base)
    assert layers() == [[f"b{i}" for i in range(5)] + [f"s{i}" for i in range(3)]] * 3
    _lines(source, {"event_id": "b9"})
    jobs.run_batch(spark, str(source), base)
    _send(spark, events, sent, {"event_id": "s9"}, {"event_id": "bad", "date": "bad"})
    jobs.run_bronze_then_batch(spark, readers.read_messages_files(spark, str(sent)), base, quarantine=True)
    want = sorted([f"b{i}" for i in range(5)] + ["b9", "s0", "s1", "s2", "s9"])
    bronze, silver, fact = layers()
    assert bronze == sorted([*want, "bad"]) and silver == fact == want


def test_stream_sets_malformed_rows_aside(spark, events, tmp_path):
    base, sent = str(tmp_path / "lake"), tmp_path / "sent"
    _send(spark, events, sent, {"event_id": "a"}, {"event_id": "z", "date": "bad"})
    for query in jobs.run_stream(readers.read_messages_files(spark, str(sent)), base, trigger=NOW, quarantine=True):
        query.awaitTermination()
    assert set(by_id(readers.read_table(spark, base, jobs.SILVER_STREAM), "ctr")) == {"a"}
    assert set(by_id(readers.read_table(spark, base, f"{jobs.QUARANTINE}_stream"), "clicks")) == {"z"}


def test_steps_after_the_build(spark, tmp_path):
    source, base = tmp_path / "in", str(tmp_path / "lake")
    named = [{"event_id": "a", "campaign_name": "Old"}, {"event_id": "b", "campaign_name": "New", "date": "2024-02-01"}]
    _lines(source, *named)
    jobs.run_batch(spark, str(source), base)
    assert jobs.run_validate(spark, base)["repeated campaign_id"] == 1
    jobs.run_batch(spark, str(source), base, latest=True)
    args = jobs.parse_arguments(
        ["batch", "--input", str(source), "--base", base, "--validate", "--cluster", "--register", "ads_test", "--export", str(tmp_path / "csv")]
    )
    jobs.after_build(spark, args)
    report = jobs.run_validate(spark, base)
    assert report.pop("fact rows") == 2 and set(report.values()) == {0}
    assert spark.table("ads_test.fact_ad_impressions").count() == 2
    assert spark.table("ads_test.silver_events").where("platform = 'Google'").count() == 2
    assert spark.read.parquet(f"{base}/gold/fact_ad_impressions_clustered").count() == 2
    assert readers.read_mart_csv(spark, f"{tmp_path}/csv/dim_campaign", schemas.DIM_CAMPAIGN).first().campaign_name == "New"


@pytest.mark.parametrize(
    "line",
    ["batch --base x", "produce --input x", "bronze --base x", "stream --base x --servers s --topic t --export y"],
)
def test_arguments_that_do_not_fit(line):
    with pytest.raises(SystemExit):
        jobs.parse_arguments(line.split())


def test_without_quarantine_bad_rows_stay_in_silver_and_leave_the_fact(spark, tmp_path):
    source = tmp_path / "in"
    _lines(source, {"event_id": "a"}, "not json")
    base = str(tmp_path / "lake")
    jobs.run_batch(spark, str(source), base)
    assert readers.read_table(spark, base, jobs.SILVER, schema=schemas.SILVER).count() == 2
    assert readers.read_table(spark, base, "gold/fact_ad_impressions").count() == 1


def _session(folder, master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder}, sparkContext=context)


def test_shared_dir_is_the_one_the_cluster_names():
    assert shared_dir(_session("/tmp/some-shared-folder/", "yarn")) == "/tmp/some-shared-folder"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session(None, "yarn"))


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="kafka"):
        readers.read_events_kafka(spark, "localhost:9092", "ad-impressions")


def test_text_exports_can_be_compressed(spark, events, tmp_path):
    """Files of bounded size, as one task reads a compressed file whole."""
    df = events({}, {"impressions": None})
    writers.write_events_json(df, str(tmp_path / "out"))
    assert list((tmp_path / "out").glob("*.json.gz")) and not list((tmp_path / "out").glob("*.json"))
    daily = marts.campaign_daily(build_silver(df))
    path = writers.export_csv(daily, str(tmp_path), "daily", compression="gzip")
    assert list(Path(path).glob("*.csv.gz"))
    assert readers.read_mart_csv(spark, path, schemas.CAMPAIGN_DAILY).exceptAll(daily).count() == 0


def test_packed_texts_come_back_as_they_were(spark):
    """Missing, empty, with the marks themselves, and bytes that are no UTF-8."""
    odd = ["", None, "a", "-", "\x01", "\x02", "\x02a\x01", "é\n", "0"]
    rows = [(a, b, i) for i, (a, b) in enumerate((a, b) for a in odd for b in odd)]
    df = spark.createDataFrame(rows, "a string, b string, i int")
    df = df.union(df.limit(1).select(F.expr("CAST(X'FF01FE' AS STRING)"), F.lit("b"), F.lit(-1)))
    df = df.union(df.limit(1).select(F.expr("CAST(X'FFFE' AS STRING)"), F.lit("b"), F.lit(-2)))
    bytes_of = [F.hex(F.col(c).cast("binary")).alias(c) for c in "ab"]
    back = unpack(pack(df, ["b", "a"], "t"), ["b", "a"], "t").select(*bytes_of, "i")
    assert sorted(back.collect(), key=str) == sorted(df.select(*bytes_of, "i").collect(), key=str) and back.count() == 83


def test_bronze_stream_sends_packed_rows(spark, events, tmp_path):
    """No text column of its own goes through the shuffle of the ids; the rows are as they were sent."""
    rows = [{"event_id": "a", "campaign_name": "\x01", "advertiser": None}, {"event_id": None, "channel": ""}, {"event_id": "=b"}]
    _send(spark, events, tmp_path / "in", *rows, *rows)
    messages = readers.read_messages_files(spark, str(tmp_path / "in"))
    plan = streams.each_once(readers.parse_events(messages))._jdf.queryExecution().analyzed().toString()
    below = plan.split("DeduplicateWithinWatermark")[1].split("\n")[2]
    assert "Project [_arrived#" in below and "_id#" in below and "concat_ws" in below
    assert not any(f", {c}#" in below.split(" CASE ")[0] for c in ("event_id", "advertiser", "channel", "date"))
    streams.stream_bronze(messages, str(tmp_path / "table"), str(tmp_path / "ckpt"), NOW).awaitTermination()
    stored = readers.read_table(spark, str(tmp_path), "table", schema=schemas.RAW)
    want = events(*rows, rows[1])
    assert stored.count() == 4 and stored.exceptAll(want).count() == 0


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_writes_and_streams_leave_no_shuffle_files(spark, events, tmp_path):
    df = events(*[{"event_id": f"e{i}", "platform": f"P{i % 3}"} for i in range(30)])
    writers.to_kafka_messages(df).write.parquet(str(tmp_path / "in"))
    before = _shuffle_files(spark)
    writers.write_table(df, str(tmp_path), "table", partition_by=["platform"])
    jobs.append_bronze(readers.read_messages_files(spark, str(tmp_path / "in")), str(tmp_path / "lake"))
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and jobs.read_bronze(spark, str(tmp_path / "lake")).count() == 30
