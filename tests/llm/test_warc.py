"""WARC archives: exact round trips and damaged records."""

import io
from collections import Counter

import pytest
from admetrics.llm import warc
from admetrics.llm.files import reading


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


ROWS = [
    (5, "http://a.org/x?a=1&b=2", "<p>same</p>"),
    (2, "http://a.org/ü \n:y", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (3, "http://b.org", None),
    (1, "http://b.org", ""),
    (7, "http://c.org", "x\r\n\r\ny" * 100_000),
    (None, "http://d.org", "alone"),
    (None, "http://d.org", "<p>same</p>"),
    (8, "http://e.org", "twice"),
    (8, "http://e.org", "twice"),
]


def test_round_trip(spark):
    archives = warc.write_archives(rows_of(spark, *ROWS).repartition(3), max_bytes=300)
    assert archives.count() > 2
    got = warc.read_archives(archives, with_payload=True).collect()
    assert archives.agg({"n_records": "sum"}).first()[0] == len(got) == len(ROWS)
    first = {}
    for page_id, _, html in ROWS:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    for r in got:
        html = next(h or "" for p, _, h in ROWS if p == r.page_id and warc.base32_sha1((h or "").encode()) == r.payload_digest)
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == warc.base32_sha1(html.encode())
        leader = first.get(html)
        if leader is None or r.page_id == leader:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, html.encode())
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("revisit", leader, b"")
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in ROWS)
    assert {r.url for r in got if r.page_id in (5, 2, 9)} == {"http://a.org/x?a=1&b=2", "http://a.org/ü%20%0A:y", None}


def test_small_payloads_are_responses(spark):
    found = warc.read_archives(warc.write_archives(rows_of(spark, *ROWS), min_bytes=6)).collect()
    assert {r.record_type for r in found if r.page_id in (1, 3, 8)} == {"response"}
    assert {r.page_id for r in found if r.record_type == "revisit"} == {5, 9, None}


def test_every_archive_has_a_task(spark):
    rows = [(i, f"http://a.org/{i}", f"<p>{i}</p>" * 50) for i in range(60)]
    frame = rows_of(spark, *rows).selectExpr("*", "1 AS payload", "2 AS digest", "3 AS refers_to", "'r' AS record_type")
    archives = warc.write_archives(frame.repartition(5), max_bytes=900)
    found = warc.read_archives(archives)
    assert found.rdd.getNumPartitions() == archives.count() > 10 and found.count() == 60


def test_empty_table(spark):
    archives = warc.write_archives(rows_of(spark, *ROWS).limit(0))
    assert archives.count() == 0 and warc.read_archives(archives).count() == 0


def test_faults_are_found(spark):
    archives = warc.write_archives(rows_of(spark, ROWS[0]))
    with reading(archives.first().path) as source:
        packed = source.read()
    member = next(warc.members(io.BytesIO(packed)))
    assert warc.parse(member)["page_id"] == 5
    for bad in (b"", member[:-1], member.replace(b"same", b"sane"), member.replace(b"WARC/", b"CRAW/"), member + b"x"):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.members(io.BytesIO(packed[:-9])))
