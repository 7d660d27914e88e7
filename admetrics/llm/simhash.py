"""Near-duplicates by SimHash fingerprints, compared at the anchor points of a covering code.

A fingerprint's 64 bits are three words of at most 23 bits, padded with zeros. The anchors are the words of the binary Golay
code, whose covering radius is 3: every word has exactly one anchor within 3 bits, its home. Two fingerprints that
differ in at most `bits` bits differ in at most bits // 3 of them in one of the three words. So each fingerprint goes to its home anchor and to
all anchors within 3 + bits // 3 of each word; there it meets every fingerprint it could be linked with, and the homes are compared with all that came.

Beyond `PAIRED_FROM` distinct fingerprints the anchors are pairs of Golay words, of which two words differ in at most
2 * bits // 3 bits together: more copies of each fingerprint, but 4,096 times as many anchors. Both forms find the same links.
Anchors with more than `TILE` fingerprints are dealt into tiles of homes x others, so no task holds a whole hot anchor. A tile
returns a spanning forest of its links, never all pairs; components are joined from these.

Defined cases: text is lower-cased in A-Z only and cut at `[\\x20\\x09-\\x0D]`; fewer words than a shingle give one shingle of all
of them; a null or blank text has fingerprint zero, which is linked like any other. Exact copies share a fingerprint
and are compared once. A component is named by its smallest doc_id; null ids take the name of the others, or null. Repeated rows are
kept. Extra columns are not carried along by `near_duplicates`. Empty tables give empty results.
"""

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from admetrics.llm.components import components
from admetrics.llm import workers
from admetrics.session import materialize

#: Distinct fingerprints from which pairs of Golay words are the anchors, and fingerprints of an anchor compared in one tile.
PAIRED_FROM = 1 << 25
TILE = 1 << 14

#: Generator polynomial of the binary Golay code of length 23 and its covering radius: fixed values.
_GENERATOR, _LENGTH, _RADIUS = 0xC75, 23, 3
_WORDS = ((0, 22), (22, 21), (43, 21))
_SEED = 42
_BLOCK = 1 << 14
_ROWS = 256


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit SimHash of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(spans), _BLOCK):
        hashes = np.array([digest(joined[s:e], _SEED) for s, e in spans[k : k + _BLOCK]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(spans), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, keys, text="text", shingle=4) -> DataFrame:
    """The key columns and `fp`, the fingerprint as a signed 64-bit integer."""

    def make(batches):
        workers.held("fingerprints", object)
        for batch in batches:
            for k in range(0, len(batch), _ROWS):
                part = batch.slice(k, _ROWS)
                found = np.array([fingerprint(t, shingle) for t in part.column("_text").to_pylist()], np.uint64)
                columns = [part.column(i) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], [*keys, "fp"])

    rows = docs.select(*keys, F.col(f"`{text}`").alias("_text"))
    schema = docs.select(*keys).withColumn("fp", F.lit(0).cast("bigint")).schema
    return rows.mapInArrow(make, schema)


def _remainder(word: int) -> int:
    for shift in range(_LENGTH - 1, 10, -1):
        if word >> shift & 1:
            word ^= _GENERATOR << (shift - 11)
    return word


@cache
def _cosets(extra: int):
    """Error patterns of weight <= radius + extra by syndrome: syndrome tables of the low and high bits, first pattern of each
    syndrome, number of patterns, the patterns, and by how much each exceeds the radius."""
    unit = [_remainder(1 << i) for i in range(_LENGTH)]

    def table(bits):
        out = np.zeros(1, np.int64)
        for i in bits:
            out = np.concatenate([out, out ^ unit[i]])
        return out

    low, high = table(range(12)), table(range(12, _LENGTH))
    patterns, excess = [], []
    for weight in range(_RADIUS + extra + 1):
        for places in combinations(range(_LENGTH), weight):
            patterns.append(sum(1 << i for i in places))
            excess.append(max(0, weight - _RADIUS))
    patterns, excess = np.array(patterns, np.int64), np.array(excess, np.int64)
    syndrome = low[patterns & 0xFFF] ^ high[patterns >> 12]
    order = np.lexsort([excess, syndrome])
    counts = np.bincount(syndrome, minlength=1 << 11)
    return low, high, np.cumsum(counts) - counts, counts, patterns[order], excess[order]


def _near(words: np.ndarray, extra: int):
    """All anchors within radius + extra of each word: index of the word, anchor, excess."""
    low, high, first, counts, patterns, excess = _cosets(extra)
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    n = counts[syndrome]
    index = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(index)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[syndrome], n)
    return index, words[index] ^ patterns[at], excess[at]


def anchors(fps: np.ndarray, bits: int, paired: bool):
    """Where fingerprints are compared: (cell, index of the fingerprint, whether the cell is its home)."""
    fps = fps.astype(np.uint64)
    words = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in _WORDS]
    for k in range(3):
        if not paired:
            index, anchor, excess = _near(words[k], bits // 3)
            yield (k << 46) | anchor, index, excess == 0
            continue
        extra = 2 * bits // 3
        index, first, used = _near(words[k], extra)
        other, second, more = _near(words[(k + 1) % 3][index], extra)
        within = used[other] + more <= extra
        other, second, more = other[within], second[within], more[within]
        yield (k << 46) | (first[other] << 23) | second, index[other], (used[other] + more) == 0


def _forest(homes: np.ndarray, others: np.ndarray, bits: int):
    """A spanning forest of the links between homes and others, as two arrays of fingerprints."""
    nodes, where = np.unique(np.concatenate([homes, others]), return_inverse=True)
    at_home, at_other = where[: len(homes)], where[len(homes) :]
    root = np.arange(len(nodes))
    itself = np.isin(at_home, at_other)
    rows = max(1, (1 << 20) // max(1, len(others)))
    for k in range(0, len(homes), rows):
        close = np.bitwise_count(homes[k : k + rows, None] ^ others[None, :]) <= bits
        for i in np.flatnonzero(close.sum(1) > itself[k : k + rows]):
            met = np.unique(root[np.append(at_other[close[i]], at_home[k + i])])
            if len(met) > 1:
                root[np.isin(root, met[1:])] = met[0]
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def links(fps: DataFrame, bits: int, paired: bool, tile=TILE) -> DataFrame:
    """Edges (a, b) that join all linked distinct fingerprints of the column fp."""

    def spread(batches):
        for batch in batches:
            own = batch.column("fp").to_numpy(zero_copy_only=False)
            for k in range(0, len(own), 4096):
                part = own[k : k + 4096]
                for cell, index, home in anchors(part.view(np.uint64), bits, paired):
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(part[index]), pa.array(home)], ["cell", "fp", "home"])

    def compare(batches):
        workers.held("fingerprints", object)
        key, held = None, []

        def finish():
            fp, role = (np.concatenate(x) for x in zip(*held))
            fp = fp.view(np.uint64)
            a, b = _forest(fp[(role & 1) > 0], fp[(role & 2) > 0], bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            cell, part, fp, role = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "tile", "fp", "role"))
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cell)]):
                if e > s:
                    if key not in (None, (cell[s], part[s])):
                        yield finish()
                        held = []
                    key = (cell[s], part[s])
                    held.append((fp[s:e], role[s:e]))
        if held:
            yield finish()

    placed = fps.select("fp").mapInArrow(spread, "cell bigint, fp bigint, home boolean")
    hot = placed.groupBy("cell").count().where(F.col("count") > tile)
    hot = materialize(hot.select("cell", F.ceil(F.col("count") / tile).cast("int").alias("fan")), "hot-anchors")
    fan, own = F.col("fan"), F.pmod(F.xxhash64("fp"), F.col("fan")).cast("int")
    steps = F.sequence(F.lit(0), fan - 1)
    as_other = F.transform(steps, lambda i: F.struct((i * fan + own).alias("tile"), F.lit(2).alias("role")))
    as_home = F.transform(steps, lambda j: F.struct((own * fan + j).alias("tile"), F.lit(1).alias("role")))
    whole = F.array(F.struct(F.lit(0).alias("tile"), F.when(F.col("home"), 3).otherwise(2).alias("role")))
    tiles = F.when(fan.isNull(), whole).when(F.col("home"), F.concat(as_other, as_home)).otherwise(as_other)
    return (
        placed.join(hot, "cell", "left")
        .select("cell", "fp", F.inline(tiles))
        .repartition("cell", "tile")
        .sortWithinPartitions("cell", "tile")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def classes(fps: DataFrame, bits: int, paired: bool | None = None, tile=TILE) -> DataFrame:
    """(fp, root) for the distinct fingerprints that are linked with another one."""
    if paired is None:
        paired = fps.count() >= PAIRED_FROM
    return components(links(fps, bits, paired, tile)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, text="text", shingle=4, bits=4, paired=None, tile=TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = materialize(fingerprints(docs, ["doc_id"], text, shingle), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    named = nodes.join(classes(nodes, bits, paired, tile), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = named.select("fp", "root").join(names, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text="text", shingle=4, bits=4) -> DataFrame:
    """One row of each component, with the columns of the input: that with the smallest doc_id, null ids last.

    Rows equal in all columns count as one. Rows are told apart by two hashes of all their columns.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(
        F.struct(*columns).alias("row"),
        F.col(f"`{text}`").alias("text"),
        F.struct(
            F.col("doc_id").isNull().alias("last"),
            F.col("doc_id").alias("doc_id"),
            F.xxhash64(*columns).alias("h1"),
            F.xxhash64(F.lit("second"), *columns).alias("h2"),
        ).alias("key"),
    )
    rows = materialize(fingerprints(keyed, ["key"], "text", shingle), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("key").alias("key")), "distinct-fingerprints")
    named = nodes.join(classes(nodes, bits), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    chosen = named.groupBy("root").agg(F.min("key").alias("key")).select("key.*")
    return (
        keyed.select("row", "key.*")
        .dropDuplicates(["h1", "h2"])
        .join(chosen.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .select("row.*")
    )
