"""Sharding by a k-d tree: weighted medians along the widest metadata dimension, down to leaves of the target bytes.

The tree is grown level by level. A node that stands for s shards is cut so that its left child gets the bytes of s // 2 of them; the cut
lies along the dimension in which the node is widest, as a share of the whole table's width. All nodes of a level are cut together, and their weighted medians are found
by narrowing: a pass over the metadata adds up the bytes of `BINS` equal slices of each node's interval, combined map-side, and the next pass looks into
the slice that holds the median, until it is narrow or has few rows. Rows with the same value are told apart by a tie: a hash of the text, so that
equal texts stay together where a cut allows it, then bits of the row's number, so that a hot group of equal rows can be cut. No row is
moved: a row's node follows from the cuts so far, a nested condition of the depth of the tree. Only the cuts, one per shard, reach the driver.

Slots number the rows of a shard without gaps: a window per shard and input partition, moved up by the counts of the partitions before.

The law is `bytes`: shards differ from the target by about the largest row, and by the tolerance of a cut at each level. The texts are read once, for sizes and hashes; the
stored metadata has a few numbers a row. Dimensions are whole numbers, dates as days, or strings, which are ordered by the first seven bytes after the prefix that
all of them share.

Defined cases: a null text has no bytes, a null dimension lies below all values. Repeated rows are rows of their own. A table of fewer rows than shards leaves
shards empty; an empty table gives no rows. Very long texts make a shard as large as they are. Other columns are ignored by `assign` and kept by `write_shards`.
"""

from dataclasses import dataclass
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window, functions as F

from admetrics.session import materialize, new_path

#: Slices of an interval in one pass, and the share of a shard's bytes that may stay on the wrong side of a cut.
BINS, TOLERANCE = 4096, 1 / 2000
#: An interval with so few rows is brought to the driver, and its median is found there.
FEW = 500
#: Bytes that a row counts beside its text.
ROW_BYTES = 16
TIE = "tie"
_TIES = 1 << 62
_WIDEST = 1 << 61


@dataclass
class Node:
    """The shards [first, first + shards); `cut` = (dimension, value, tie): rows before it go to `left`."""

    first: int
    shards: int
    cut: tuple | None = None
    left: "Node | None" = None
    right: "Node | None" = None


def dimensions(docs: DataFrame, names) -> list[Column]:
    """Order-preserving whole numbers of the named columns, null below all."""
    if not names:
        return []
    texts = {n for n, kind in docs.select(*[f"`{n}`" for n in names]).dtypes if kind in ("string", "binary")}

    def plain(name):
        column = F.col(f"`{name}`")
        kind = docs.schema[name].dataType.typeName()
        if name in texts:
            return column.cast("binary")
        return F.unix_date(column) if kind == "date" else F.least(F.greatest(column.cast("bigint"), F.lit(-_WIDEST)), F.lit(_WIDEST))

    # A min and a max of each dimension, in one pass over these columns alone.
    ends = docs.agg(*[f(plain(n)) for n in names for f in (F.min, F.max)]).first()
    out = []
    for i, name in enumerate(names):
        low, high = ends[2 * i], ends[2 * i + 1]
        if name in texts:
            shared = len(commonprefix([bytes(low or b""), bytes(high or b"")]))
            head = F.hex(F.substring(plain(name), shared + 1, 7))
            out.append(F.coalesce(F.conv(F.rpad(head, 14, "0"), 16, 10).cast("bigint") + 1, F.lit(0)))
        else:
            out.append(F.coalesce(plain(name), F.lit((low or 0) - 1)).cast("bigint"))
    return out


def metadata(docs: DataFrame, names, text="text", doc_id="doc_id") -> DataFrame:
    """Stored (row, doc_id, size, text_crc32, d0, d1, ..., tie), without texts."""
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    row = F.monotonically_increasing_id()
    by_text = F.shiftrightunsigned(F.xxhash64(raw), 16) * (1 << 14)
    return materialize(
        docs.select(
            row.alias("row"),
            F.col(f"`{doc_id}`").alias("doc_id"),
            (F.length(raw) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            *[d.alias(f"d{i}") for i, d in enumerate(dimensions(docs, names))],
            (by_text + F.pmod(F.xxhash64(row), F.lit(1 << 14))).alias(TIE),
        ),
        "shard-metadata",
    )


def _before(cut) -> Column:
    dimension, value, tie = cut
    if dimension == TIE:
        return F.col(TIE) < tie
    return (F.col(dimension) < value) | ((F.col(dimension) == value) & (F.col(TIE) < tie))


def shard_of(node: Node) -> Column:
    """The first shard of a row's node."""
    if node.left is None:
        return F.lit(node.first)
    return F.when(_before(node.cut), shard_of(node.left)).otherwise(shard_of(node.right))


def _placed(meta, root, searches) -> DataFrame:
    """The rows inside the searches' intervals, with `node` and their place `x` in it: a value, or a tie among the rows with one value."""
    fields = ("dimension", "value", "low", "high", "width", "rest")
    rows = [(first, *[getattr(s, f) for f in fields]) for first, s in searches.items()]
    text = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}L" if isinstance(v, int) else f"{v!r}D" for v in row) + ")" for row in rows)
    # One row per node that is being cut, fewer than shards.
    table = meta.sparkSession.sql(f"SELECT node, dimension, CAST(value AS BIGINT) AS value, low, high, width, rest FROM VALUES {text} AS t(node, {', '.join(fields)})")
    names = _dimensions_of(meta)
    value = F.coalesce(*[F.when(F.col("dimension") == n, F.col(n)) for n in names]) if names else F.lit(None).cast("bigint")
    x = F.when(F.col("dimension") == TIE, F.col(TIE)).when(F.col("value").isNull(), value).when(value == F.col("value"), F.col(TIE))
    numbered = meta.withColumn("node", shard_of(root).cast("bigint"))
    return numbered.join(F.broadcast(table), "node").withColumn("x", x).where("x BETWEEN low AND high")


def _slices(meta, root, searches) -> dict:
    """The slice of each search's interval in which its target lies: number, bytes before it, its bytes and rows."""
    sums = (
        _placed(meta, root, searches)
        .groupBy("node", F.expr("(x - low) div width").alias("slice"))
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest"))
    )
    upto = Window.partitionBy("node").orderBy("slice")
    summed = sums.withColumn("end", F.sum("bytes").over(upto))
    found = summed.where("end >= rest").withColumn("place", F.row_number().over(upto)).where("place = 1")
    return {r.node: (r.slice, r.end - r.bytes, r.bytes, r.n) for r in found.collect()}


def _exact(meta, root, searches) -> None:
    """Ends the searches whose intervals hold few rows, from these rows."""
    rows = _placed(meta, root, searches).groupBy("node", "x", TIE).agg(F.sum("size").alias("bytes")).collect()
    for first, s in searches.items():
        before, at = 0, None
        for x, tie, size in sorted((r.x, r[TIE], r.bytes) for r in rows if r.node == first):
            if before + size / 2 >= s.rest:
                at = (x, tie)
                break
            before += size
        s.cut_at(*(at or (s.high + 1, 0)))


@dataclass
class Search:
    """A node's weighted median: it lies in [low, high] of a dimension, or of the ties of one value, `rest` bytes from the start."""

    node: Node
    dimension: str
    low: int
    high: int
    rest: float
    value: int | None = None
    width: int = 1

    def in_ties(self) -> bool:
        return self.value is not None or self.dimension == TIE

    def cut_at(self, x, tie=0) -> None:
        if self.dimension == TIE:
            self.node.cut = (TIE, 0, x)
        else:
            self.node.cut = (self.dimension, self.value, x) if self.in_ties() else (self.dimension, x, tie)


def _cuts(meta, root, nodes, whole):
    """Finds the cut of every node of a level."""
    dims = list(whole["width"])
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in [*dims, TIE] for f in (F.min, F.max)]
    sizes = meta.withColumn("node", shard_of(root)).groupBy("node").agg(F.sum("size").alias("bytes"), *ends)
    facts = {r.node: r for r in sizes.where(F.col("node").isin([n.first for n in nodes])).collect()}
    searches, few = {}, {}
    for node in nodes:
        if node.first not in facts:
            node.cut = (TIE, 0, 0)
            continue
        r = facts[node.first]
        share = {d: (r[f"max_{d}"] - r[f"min_{d}"]) / whole["width"][d] for d in dims if whole["width"][d]}
        widest = max(share, key=share.get, default=TIE)
        if not share or share[widest] == 0:
            widest = TIE
        searches[node.first] = Search(node, widest, r[f"min_{widest}"], r[f"max_{widest}"], r.bytes * (node.shards // 2) / node.shards)
    while searches:
        for s in searches.values():
            s.width = -(-(s.high - s.low + 1) // BINS)
        found = _slices(meta, root, searches)
        for first, s in list(searches.items()):
            number, before, size, n = found[first]
            low = s.low + number * s.width
            high = min(s.high, low + s.width - 1)
            s.rest -= before
            if size <= TOLERANCE * whole["target"] or (s.in_ties() and low == high):
                # The slice goes to the side that comes closer to the target.
                s.cut_at(high + 1 if s.rest > size / 2 else low)
                del searches[first]
                continue
            if not s.in_ties() and low == high and n > FEW:
                s.value, s.low, s.high = low, 0, _TIES - 1
            else:
                s.low, s.high = low, high
            if n <= FEW:
                few[first] = searches.pop(first)
    if few:
        _exact(meta, root, few)
    for node in nodes:
        half = node.shards // 2
        node.left, node.right = Node(node.first, half), Node(node.first + half, node.shards - half)


def _dimensions_of(meta) -> list[str]:
    return [c for c in meta.columns if c[0] == "d" and c[1:].isdigit()]


def grow(meta: DataFrame, shards: int) -> Node:
    """The tree over stored metadata; its leaves are the shards 0, 1, ..."""
    dims = _dimensions_of(meta)
    first = meta.agg(F.sum("size"), *[f(d) for d in dims for f in (F.min, F.max)]).first()
    root = Node(0, shards)
    if first[0] is None:
        return root
    width = {d: first[2 + 2 * i] - first[1 + 2 * i] for i, d in enumerate(dims)}
    whole = {"width": width, "target": first[0] / shards}
    level = [root]
    while level := [n for n in level if n.shards > 1]:
        _cuts(meta, root, level, whole)
        level = [child for n in level for child in (n.left, n.right)]
    return root


def with_slots(rows: DataFrame) -> DataFrame:
    """Adds `slot`, the number of the row within its `shard`; `row` orders the rows and its upper bits are the input partition."""
    parts = rows.withColumn("_part", F.shiftright("row", 33))
    sizes = parts.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per shard and input partition.
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    here = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("row")) - 1
    numbered = parts.withColumn("_here", here).join(starts, ["shard", "_part"])
    return numbered.withColumn("slot", F.col("_start") + F.col("_here")).drop("_part", "_here", "_start")


def assign(docs: DataFrame, dims, shards: int, text="text", doc_id="doc_id") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    meta = metadata(docs, dims, text, doc_id)
    placed = meta.withColumn("shard", shard_of(grow(meta, shards)))
    return with_slots(placed.select("row", "doc_id", "size", "text_crc32", "shard")).select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, dims, shards: int, text="text") -> str:
    """Writes the rows, with all their columns, into one folder per shard; returns the path.

    A shard becomes as many files as tasks wrote to it; a row's columns are in the struct `row`.
    """
    packed = docs.select(F.monotonically_increasing_id().alias("number"), F.struct("*").alias("row"))
    stored = materialize(packed.withColumn("_text", F.col(f"row.`{text}`")).select("number", "row", "_text"), "shard-rows")
    columns = [F.col(f"row.`{d}`").alias(f"_{d}") for d in dims]
    meta = metadata(stored.select("number", "_text", *columns), [f"_{d}" for d in dims], "_text", "number")
    tree, path = grow(meta, shards), new_path(docs.sparkSession, "shards")
    where = meta.select(F.col("doc_id").alias("number"), shard_of(tree).alias("shard"))
    rows = stored.select("number", "row").join(where, "number").select("row", "shard")
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return path
