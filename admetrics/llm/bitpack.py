"""Token-id files: ids packed at the fewest bits that hold the vocabulary, in blocks that numpy unpacks whole.

A file holds a header, blocks of `BLOCK` ids (the last may be shorter), the index of its documents and a footer:

    header   8 bytes magic, u4 bits per id, u4 ids per block
    block k  starts at byte 16 + k * BLOCK * bits / 8; id i of a block takes bits [i * bits, (i + 1) * bits), lowest first
    index    i8 doc_id and i1 "is null" of each document, u8 end of each document in ids
    footer   u8 documents, u8 ids, u4 crc32 of the index, 8 bytes magic

Eight ids take exactly `bits` bytes, so packing and unpacking are a few shifts on columns of a byte matrix. Any run of
ids is read from the blocks that hold it.

Files are written by range partitions of doc_id, ascending over and inside files. Rows with equal ids follow their
text, nulls first. A null text is empty; the end id is still written. Files appear under their name only when complete, and
a task that runs again writes the same name. Extra columns are not stored. An empty table gives no files and no rows.
"""

import io
import struct
import string
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from admetrics.llm.bpe import byte_letters
from admetrics.llm.chunks import ChunkEncoder, in_calls
from admetrics.llm.files import one_per_task, reading, writing
from admetrics.llm.workers import held
from admetrics.session import materialize, new_path

BLOCK = 1 << 16
_MAGIC = b"IDBLOCKS"
_HEAD = struct.Struct("<8sII")
_FOOT = struct.Struct("<QQI8s")


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold ids below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def _lanes(bits):
    """For each of eight ids: its first byte, its shift, and how many bytes it touches."""
    return [(j * bits // 8, j * bits % 8, (j * bits % 8 + bits + 7) // 8) for j in range(8)]


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids to ceil(n * bits / 8) bytes."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    rows = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    rows.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(rows), bits), np.uint8)
    for j, (first, shift, touched) in enumerate(_lanes(bits)):
        moved = rows[:, j] << np.uint64(shift)
        for k in range(touched):
            out[:, first + k] |= (moved >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first n ids of packed bytes, as unsigned 32-bit integers."""
    groups = -(-n // 8)
    raw = np.frombuffer(data.ljust(groups * bits, b"\0"), np.uint8, groups * bits).reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j, (first, shift, touched) in enumerate(_lanes(bits)):
        value = raw[:, first].astype(np.uint64)
        for k in range(1, touched):
            value |= raw[:, first + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


class Writer:
    """Streams documents into an open binary file."""

    def __init__(self, out, bits):
        self._out, self._bits = out, bits
        self._doc_ids, self._ends, self._waiting, self._n_waiting, self._total = [], [], [], 0, 0
        out.write(_HEAD.pack(_MAGIC, bits, BLOCK))

    def add(self, doc_id, ids: np.ndarray):
        self._doc_ids.append(doc_id)
        self._total += len(ids)
        self._ends.append(self._total)
        self._waiting.append(ids)
        self._n_waiting += len(ids)
        if self._n_waiting >= 16 * BLOCK:
            self._flush(self._n_waiting - self._n_waiting % BLOCK)

    def _flush(self, n):
        ids = np.concatenate([*self._waiting, np.zeros(0, np.uint32)])
        self._out.write(pack(ids[:n], self._bits))
        self._waiting, self._n_waiting = [ids[n:]], len(ids) - n

    def close(self):
        self._flush(self._n_waiting)
        null = np.array([d is None for d in self._doc_ids], np.uint8)
        index = np.array([d or 0 for d in self._doc_ids], "<i8").tobytes() + null.tobytes() + np.array(self._ends, "<u8").tobytes()
        self._out.write(index)
        self._out.write(_FOOT.pack(len(self._doc_ids), self._total, zlib.crc32(index), _MAGIC))
        return len(self._doc_ids), self._total


class Reader:
    """Random access to the documents of an open binary file."""

    def __init__(self, source):
        self._source = source
        magic, self.bits, self.block = _HEAD.unpack(source.read(_HEAD.size))
        size = source.seek(0, io.SEEK_END) or source.tell()
        source.seek(size - _FOOT.size)
        n, self.n_ids, crc, end = _FOOT.unpack(source.read(_FOOT.size))
        if magic != _MAGIC or end != _MAGIC:
            raise ValueError("not a token-id file")
        source.seek(size - _FOOT.size - 17 * n)
        index = source.read(17 * n)
        if zlib.crc32(index) != crc:
            raise ValueError("the index of a token-id file is damaged")
        ids, null = np.frombuffer(index, "<i8", n), np.frombuffer(index, np.uint8, n, 8 * n)
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, null)]
        self.ends = np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids [start, end) of the file, from the blocks that hold them."""
        first = start - start % self.block
        last = min(self.n_ids, end + -end % self.block)
        self._source.seek(_HEAD.size + first * self.bits // 8)
        data = self._source.read(-(-(last - first) * self.bits // 8))
        return unpack(data, self.bits, last - first)[start - first : end - first]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.ends[k]))

    def documents(self, at_once=16 * BLOCK):
        """All (doc_id, start, ids) in order, reading whole blocks; a document of any length is one array."""
        held, held_from = np.zeros(0, np.uint32), 0
        for doc_id, start, end in zip(self.doc_ids, self.starts.tolist(), self.ends.tolist()):
            if end > held_from + len(held):
                held = self.ids(start, max(end, min(self.n_ids, start + at_once)))
                held_from = start
            yield doc_id, start, held[start - held_from : end - held_from]


_MARKS = string.punctuation


def library_encoder(tokenizer_path: str) -> ChunkEncoder:
    """The tokenizers library on chunks, kept by a worker while it serves this operator."""

    def make():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        merge, letters = tokenizer.model.tokenize, {b: c for c, b in byte_letters().items()}

        def merged(word):
            return [t.id for t in merge(word.encode().decode("latin-1").translate(letters))]

        marks = {}

        def plain(part):
            """Ids of lines of a word with marks behind it, which are pre-tokens of their own, as are the ends of lines; None for other chunks."""
            out = []
            for k, line in enumerate(part.split("\n")):
                word = line.rstrip(_MARKS)
                if not (word[1:] if k == 0 and word[:1] == " " else word).isalpha():
                    return None
                end = line[len(word) :]
                if end not in marks:
                    marks[end] = merged(end)
                out += [*newline, *merged(word), *marks[end]] if k else merged(word) + marks[end]
            if len(marks) > 10_000:
                marks.clear()
            return array("I", out).tobytes()

        newline = merged("\n")

        def encode_many(parts):
            # The library's model takes plain pre-tokens as they are.
            out = list(map(plain, parts))
            others = [i for i, ids in enumerate(out) if ids is None]
            found = tokenizer.encode_batch_fast([parts[i] for i in others], add_special_tokens=False)
            for i, e in zip(others, found):
                out[i] = array("I", e.ids).tobytes()
            return out

        return ChunkEncoder(encode_many)

    return held(("library encoder", tokenizer_path), make)


def write_files(docs: DataFrame, tokenizer_path: str, vocabulary: int, end_id: int, text="text") -> DataFrame:
    """Encodes and writes all documents; returns the stored list of files: path, part, n_docs, n_ids."""
    folder, bits = new_path(docs.sparkSession, "ids"), bits_for(vocabulary)

    def write(batches):
        encode, end = library_encoder(tokenizer_path), np.array([end_id], np.uint32)
        part, batch = TaskContext.get().partitionId(), next(batches, None)
        if batch is None:
            return
        path = f"{folder}/part-{part:06d}.ids"
        with writing(path) as out:
            writer = Writer(out, bits)
            while batch is not None:
                doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                for at, call in in_calls(texts):
                    for doc_id, ids in zip(doc_ids[at:], encode(call)):
                        writer.add(doc_id, np.concatenate([np.frombuffer(ids, "<u4"), end]))
                batch = next(batches, None)
            n_docs, n_ids = writer.close()
        yield pa.RecordBatch.from_pydict(
            {"path": [path], "part": pa.array([part], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids]}
        )

    ordered = (
        docs.select("doc_id", F.col(f"`{text}`").alias("text"), F.substring(F.col(f"`{text}`"), 1, 64).alias("tie"), F.monotonically_increasing_id().alias("row"))
        # A null or repeated id is cut like any other, since equal ids follow the start of their text and then the row's number.
        .repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text")
    )
    return materialize(ordered.mapInArrow(write, "path string, part int, n_docs bigint, n_ids bigint"), "ids-list")


def read_files(files: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (over all files), n_tokens, ids_crc32."""
    # One row per file: the running total is over file sizes only.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches):
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                with reading(path) as source:
                    found = Reader(source)
                    rows = [(d, first + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, s, ids in found.documents()]
                for i in range(0, len(rows), 10_000):
                    doc_id, start, n, crc = map(list, zip(*rows[i : i + 10_000]))
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array(doc_id, pa.int64()), "start": start, "n_tokens": n, "ids_crc32": crc}
                    )

    return one_per_task(listed.select("path", "first")).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
