"""Benchmark decontamination by greedy string tiling.

Tokens are lower-cased runs of word characters, and single characters in scripts that put no spaces between words. A seed is the Karp-Rabin value of
`least` tokens in a row, or of a whole item that is shorter. Documents and items that
share a seed are joined. The places of the shared seeds in the item bound what can be covered, so a pair that cannot reach the wanted coverage, such as
one that shares a common phrase alone, ends there, before any text is joined. For each other pair the longest match that is free in both texts is marked as a tile, again and
again, until no match of `least` tokens is left. The share of an item's tokens under tiles is its coverage, whatever the order
in which the document has them, so passages whose sentences were moved are found too. A match counts after its tokens are compared.

Seeds of documents are looked up in a bitmap of `2 ** BITS` bits made from the benchmark's, of the same size for any benchmark; it only thins
out what is joined. Equal texts are tiled once. What is returned are pairs, one row per document text, doc_id and item.

Defined cases: null and empty texts and items have no tokens and match nothing. An item with fewer than `least` tokens is matched as a whole. Items with equal
tokens count as one, named by the smallest item_id. A null doc_id is kept. Rows equal in doc_id and text give one row. Extra columns are
not carried along by `pairs`; `decontaminate` returns its input's columns. Empty tables give no pairs.
"""

import hashlib
import heapq
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from admetrics.llm.chunks import in_calls
from admetrics.llm import workers
from admetrics.session import materialize

LEAST = 5
COVERAGE = 0.6
BITS = 24
#: Letters of scripts without spaces between words (kana, Han, Thai, Lao, Khmer, Burmese): fixed ranges.
_ALONE = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1780-\u17ff\u1000-\u109f\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_ALONE}]|[^\W{_ALONE}]+")
_BASE = np.uint64(0x100000001B3)


def tokens_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _codes(tokens) -> np.ndarray:
    return np.fromiter(map(crc32, map(str.encode, tokens)), np.uint32, len(tokens)).astype(np.uint64)


def rolling(codes: np.ndarray, least: int) -> np.ndarray:
    """Karp-Rabin value of each window of `least` codes."""
    n = max(0, len(codes) - least + 1)
    value = np.zeros(n, np.uint64)
    for k in range(least):
        value = value * _BASE + codes[k : k + n] + np.uint64(1)
    # Spread over all bits, as the bitmap looks at the lowest.
    value ^= value >> np.uint64(32)
    return value * np.uint64(0x9E3779B97F4A7C15)


def _free_runs(free: np.ndarray, least: int):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if e - s >= least:
            yield s, e - s


def _matches(item, doc, least):
    """All maximal matches as (length, place in item, place in doc).

    Only pairs of equal windows that no equal pair of tokens precedes are enumerated, so long repeats stay linear.
    """
    numbers = {t: i for i, t in enumerate(dict.fromkeys(item))}
    p = np.array([numbers[t] for t in item], np.int64)
    d = np.array([numbers.get(t, -1) for t in doc], np.int64)
    p_hash, d_hash = (rolling(x.astype(np.uint64), least) for x in (p, d))
    keep = np.flatnonzero(np.isin(d_hash, p_hash))
    before_d = np.where(keep > 0, d[np.maximum(keep, 1) - 1], -2)
    order = np.lexsort([before_d, d_hash[keep]])
    keep, before_d = keep[order], before_d[order]
    hashes = d_hash[keep]
    starts_p, starts_d = [], []
    for i, h in enumerate(p_hash):
        s, e = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        if s == e:
            continue
        same = p[i - 1] if i else -3
        a, b = s + np.searchsorted(before_d[s:e], same, "left"), s + np.searchsorted(before_d[s:e], same, "right")
        found = np.concatenate([keep[s:a], keep[b:e]])
        starts_p.append(np.full(len(found), i))
        starts_d.append(found)
    if not starts_p:
        return []
    at_p, at_d = np.concatenate(starts_p), np.concatenate(starts_d)
    length, live = np.zeros(len(at_p), np.int64), np.arange(len(at_p))
    while len(live):
        i, j = at_p[live] + length[live], at_d[live] + length[live]
        inside = (i < len(p)) & (j < len(d))
        live = live[inside][p[i[inside]] == d[j[inside]]]
        length[live] += 1
    good = length >= least
    return list(zip((-length[good]).tolist(), at_p[good].tolist(), at_d[good].tolist()))


def tiles(item: list[str], doc: list[str], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in doc, length), longest first; ties go to the first place in item, then in doc."""
    heap = _matches(item, doc, least)
    heapq.heapify(heap)
    taken_p, taken_d, out = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    while heap:
        length, at_p, at_d = heapq.heappop(heap)
        length = -length
        free = ~(taken_p[at_p : at_p + length] | taken_d[at_d : at_d + length])
        if free.all():
            taken_p[at_p : at_p + length] = taken_d[at_d : at_d + length] = True
            out.append((at_p, at_d, length))
            if not any(True for _ in _free_runs(~taken_p, least)):
                break
            continue
        for s, n in _free_runs(free, least):
            heapq.heappush(heap, (-n, at_p + s, at_d + s))
    return out


def _items(benchmark: DataFrame, text, least):
    """Distinct items with the seeds at each of their places: item_id, words, width (tokens of a seed), seeds."""

    def read(batches):
        for batch in batches:
            words = [tokens_of(t) for t in batch.column("text").to_pylist()]
            width = [min(least, len(w)) for w in words]
            seeds = [rolling(_codes(w), n).view(np.int64).tolist() if n else [] for w, n in zip(words, width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([" ".join(w) for w in words], pa.string()), pa.array(width, pa.int32()), pa.array(seeds, pa.list_(pa.int64()))],
                ["item_id", "words", "width", "seeds"],
            )

    rows = benchmark.select("item_id", F.col(f"`{text}`").alias("text")).mapInArrow(read, "item_id bigint, words string, width int, seeds array<bigint>")
    distinct = rows.where("width > 0").groupBy("words").agg(F.min("item_id").alias("item_id"), F.first("width").alias("width"), F.first("seeds").alias("seeds"))
    return materialize(distinct, "benchmark-items")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The benchmark's seeds as bits: at most 2 ** BITS of them, packed by Spark into pieces of 4 KB."""
    at = F.pmod("seed", F.lit(1 << BITS)) + 1
    parts = seeds.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(1 << BITS >> 3, np.uint8)
    for row in parts.collect():
        start = (row.bucket - 1) * 4096
        out[start : start + 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def _reachable(shared: DataFrame) -> DataFrame:
    """Per pair the most tokens of the item that matches can cover: those under windows whose seeds the document has too."""
    # At most as many places as the item has tokens.
    pair = shared.groupBy("digest", "item_id").agg(F.sort_array(F.collect_set("place")).alias("places"), F.first("width").alias("width"), F.first("size").alias("size"))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def cover(seen, place):
        end = place + F.col("width")
        return F.struct((seen["n"] + end - F.greatest(seen["end"], place)).alias("n"), end.alias("end"))

    return pair.select("digest", "item_id", "size", F.aggregate("places", start, cover)["n"].alias("most"))


def pairs(docs: DataFrame, benchmark: DataFrame, text="text", least=LEAST, coverage=0.0) -> DataFrame:
    """Every document and item that share a seed: doc_id, item_id, digest (MD5 of the text), n_tiles, n_covered, coverage.

    Pairs that cannot reach `coverage` are left out before they are tiled; others may still be below it.
    """
    items = _items(benchmark, text, least)
    seeds = items.select("item_id", "width", (F.size("seeds") + F.col("width") - 1).alias("size"), F.posexplode("seeds").alias("place", "seed"))
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds))
    # At most `least` of them.
    widths = sorted(r.width for r in items.select("width").distinct().collect())

    def scan(batches):
        workers.held("tiling", object)
        bits = sent.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for at, call in in_calls(texts):
                words = [tokens_of(t) for t in call]
                ends = np.cumsum([len(w) for w in words])
                codes, found = _codes([t for w in words for t in w]), {}
                for width in widths:
                    values = rolling(codes, width).view(np.int64)
                    place = values & ((1 << BITS) - 1)
                    hit = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                    doc = np.searchsorted(ends, hit, "right")
                    inside = hit + width <= ends[doc] if len(hit) else hit
                    hit, doc = hit[inside], doc[inside]
                    for k in np.unique(doc).tolist():
                        found.setdefault(k, []).append(values[hit[doc == k]])
                if found:
                    which = sorted(found)
                    kept = [call[k] for k in which]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(np.array(which) + at)),
                            pa.array([hashlib.md5(t.encode()).hexdigest() for t in kept]),
                            pa.array(kept),
                            pa.array([np.unique(np.concatenate(found[k])).tolist() for k in which], pa.list_(pa.int64())),
                        ],
                        ["doc_id", "digest", "text", "seeds"],
                    )

    def tile(batches):
        workers.held("tiling", object)
        for batch in batches:
            rows = []
            for words, width, body in zip(*(batch.column(c).to_pylist() for c in ("words", "width", "text"))):
                item = words.split(" ")
                made = tiles(item, tokens_of(body), width)
                rows.append((len(made), sum(x[2] for x in made), len(item)))
            n, covered, size = map(np.array, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("item_id"), pa.array(n), pa.array(covered), pa.array(covered / size)],
                ["digest", "item_id", "n_tiles", "n_covered", "coverage"],
            )

    rows = docs.select("doc_id", F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    hits = materialize(rows.mapInArrow(scan, "doc_id bigint, digest string, text string, seeds array<bigint>"), "seeded-documents")
    texts = hits.groupBy("digest").agg(F.first("text").alias("text"), F.first("seeds").alias("seeds"))
    shared = texts.select("digest", F.explode("seeds").alias("seed")).join(seeds, "seed")
    hopeful = _reachable(shared).where(F.col("most") >= F.lit(coverage) * F.col("size")).select("digest", "item_id")
    work = hopeful.join(items.select("item_id", "words", "width"), "item_id").join(texts.select("digest", "text"), "digest")
    tiled = work.mapInArrow(tile, "digest string, item_id bigint, n_tiles bigint, n_covered bigint, coverage double")
    tiled = materialize(tiled, "tiled-pairs")
    return hits.select("doc_id", "digest").distinct().join(tiled, "digest").select("doc_id", "item_id", "digest", "n_tiles", "n_covered", "coverage")


def contaminated(docs: DataFrame, benchmark: DataFrame, text="text", least=LEAST, coverage=COVERAGE) -> DataFrame:
    """The pairs whose item is covered to at least `coverage`."""
    return pairs(docs, benchmark, text, least, coverage).where(F.col("coverage") >= coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text="text", least=LEAST, coverage=COVERAGE) -> DataFrame:
    """The documents that hold no benchmark item, with their columns."""
    found = materialize(contaminated(docs, benchmark, text, least, coverage).select("digest").distinct(), "contaminated-texts")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.md5(F.col(f"`{text}`").cast("binary")).alias("digest"))
    return row.join(found, "digest", "left_anti").select("row.*")
