"""WARC archives: one gzip member per record, written and read back sequentially.

Writing: pages with equal payloads are found by SHA-1, length and a second hash; the smallest page_id of each group is
the response and the others become revisit records, whose block holds the HTTP header alone. Each task writes its rows to archives of
at most `max_bytes` compressed bytes in the shared folder. Reading: a task streams an archive through zlib, takes one member at
a time, frames the block by Content-Length and verifies block and payload digests; any fault raises ValueError.

Defined cases: a null payload counts as empty. Payloads under `min_bytes` bytes are all responses. Rows that repeat the smallest
page_id of a group are all responses; a null page_id is written without a number and is a response only if no other id
has that payload. A null URL leaves out the target; control characters and spaces in it are percent-encoded. An empty table writes
no archive and reads as no rows. Other columns of the input are not stored. A record is held in memory whole, an archive never is.
"""

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from admetrics.llm.files import one_per_task, reading, writing
from admetrics.session import materialize, new_path

_CHUNK = 1 << 18
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "<urn:x-page:{}>"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_column(payload):
    """Base-32 SHA-1 by built-in functions: four runs of 40 bits, eight digits each."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, payload="html", min_bytes=0) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for a response)."""
    body = F.encode(F.coalesce(F.col(f"`{payload}`"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumns(
        {"digest": digest_column(F.col("payload")), "n": F.length("payload").cast("bigint"), "second": F.xxhash64("payload")}
    )
    same = ["digest", "n", "second"]
    groups = (
        rows.groupBy(*same)
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where((F.col("copies") > 1) & (F.col("n") >= min_bytes) & F.col("first_id").isNotNull())
        .drop("copies")
    )
    copy = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(groups, same, "left").select(
        "page_id", "url", "payload", "digest", F.when(copy, F.col("first_id")).alias("refers_to")
    )


def _escaped(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_ID.format('' if page_id is None else page_id)}",
        f"WARC-Date: {_DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_escaped(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_ID.format(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


def write_archives(pages: DataFrame, payload="html", min_bytes=0, max_bytes=1 << 30) -> DataFrame:
    """Writes all rows and returns the stored list of archives: path, n_records."""
    folder = new_path(pages.sparkSession, "warc")

    def write(batches):
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))))
        row, number = next(rows, None), 0
        while row is not None:
            path = f"{folder}/part-{TaskContext.get().partitionId():06d}-{number:04d}.warc.gz"
            size = n = 0
            with writing(path) as out:
                while row is not None and size < max_bytes:
                    size += out.write(member := record(*row)) or len(member)
                    n += 1
                    row = next(rows, None)
            number += 1
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([n], pa.int64())})

    return materialize(plan_records(pages, payload, min_bytes).mapInArrow(write, "path string, n_records bigint"), "warc-list")


def members(source):
    """The decompressed bytes of each gzip member of a stream, one after the other."""
    rest = source.read(_CHUNK)
    while rest:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest:
                raise ValueError("archive ends inside a record")
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data or (b"" if unpacker.eof else source.read(_CHUNK))
        yield b"".join(parts)
        rest = rest or source.read(_CHUNK)


def _fields(head: bytes) -> dict:
    return {k.strip().lower(): v.strip(" \t") for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def _page(urn):
    number = urn.removeprefix("<urn:x-page:").removesuffix(">") if urn else ""
    return int(number) if number else None


def parse(member: bytes) -> dict:
    """The fields and payload of one record, verified."""
    head, found, rest = member.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    length = int(fields["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')}: Content-Length does not fit")
    if fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"record {fields.get('warc-record-id')}: block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(_fields(http)["content-length"])
    if fields["warc-type"] == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"record {fields.get('warc-record-id')}: payload digest differs")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
    }


def read_archives(archives: DataFrame, with_payload=False) -> DataFrame:
    """All records of the listed archives; the payload (of responses) only if asked for."""
    schema = RECORD + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    limit = 8 << 20

    def read(batches):
        arrow = pa.schema(list(zip(names, kinds)))
        rows, size = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with reading(path) as source:
                    for member in members(source):
                        rows.append({k: v for k, v in parse(member).items() if k in names})
                        size += len(member) if with_payload else 200
                        if size >= limit:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return one_per_task(archives.select("path")).mapInArrow(read, schema)
