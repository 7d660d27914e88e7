"""Filter interaction audit: what each filter removes, alone and after every other choice of filters.

Each filter is a relation of the rows that fail it: one stored table of ids per filter. A prefix of a filter order is a set of filters, so
one table of the rows and all sets answers every order at once. Three joins on the row id give everything:

- survivors of a set: the rows, once for each set, left-anti the failing rows of a filter in the set;
- removals: the failing rows of a filter, once for each set without that filter, left-anti the failing rows of a filter in the set;
- redundancies: the same, left-semi.

Label losses are the removals of those failing rows that are left-semi joined with the labelled ones. Counting follows at once, per part and set; an order's steps are
then read off these counts. The rows of a set are made inside the task that holds the id, so ids are shuffled once and not once for each set.

Rows are known by a number of their own, so repeated or null ids count each time. Defined cases: a null text is empty; the null part is the empty one.
A null id is never greater than another, so it does not fail the test of repeated texts, nor does it have labels. Rows of
labels that contradict each other count for both. No rows give no parts. Other columns are ignored. Hot ids and texts are split by
adaptive execution at the semi joins. Texts are read whole, once.
"""

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from admetrics.session import materialize

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def conditions(text="_text") -> dict[str, Column]:
    """Failure of the filters that look at one text: fixed thresholds."""
    t = F.col(text)
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    capitals = F.length(t) - F.length(F.translate(t, _CAPITALS, ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.length(t),
        "D": t.rlike(r"[#$%&*|]"),
    }


def repeated(checked: DataFrame) -> DataFrame:
    """The rows of `checked` (row, doc_id, part, key) whose key occurs with a smaller doc_id."""
    firsts = checked.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first")
    firsts = materialize(firsts.select("key", "first"), "first-texts").alias("f")
    rows = checked.alias("c")
    return rows.join(firsts, (F.col("c.key") == F.col("f.key")) & (F.col("c.doc_id") > F.col("f.first")), "left_semi")


def failing(docs: DataFrame, text="text", part="source", tests=conditions) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The stored rows (row, doc_id, part, ...) and one stored table (row, part) per filter: those of `tests` and E, repeated texts."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    key = F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("key")
    checks = tests("_text")
    flags = [F.coalesce(c, F.lit(False)).alias(f"fails_{n}") for n, c in checks.items()]
    checked = materialize(rows.select("row", "doc_id", "part", key, *flags), "checked")
    tables = {n: checked.where(f"fails_{n}") for n in checks} | {"E": repeated(checked)}
    return checked, {n: materialize(t.select("row", "part"), f"fails-{n}") for n, t in tables.items()}


def labelled(checked: DataFrame, labels: DataFrame) -> DataFrame:
    """The ids (row) of the rows whose doc_id is in `labels`."""
    return materialize(checked.join(labels.select("doc_id"), "doc_id", "left_semi").select("row"), "labelled")


def counts(rows: DataFrame, tables: dict[str, DataFrame], marks: dict[str, DataFrame]) -> DataFrame:
    """(part, kind, filter, set, n), with filters as bits: `kept` of a set, `removed`, `redundant` and each mark's removals of a filter after a set.

    `rows` and the filters' `tables` have (row, part), the `marks` have (row).
    """
    bits = {name: 1 << i for i, name in enumerate(tables)}
    sets = F.sequence(F.lit(0), F.lit((1 << len(bits)) - 1))

    def union(frames):
        first, *rest = frames
        for frame in rest:
            first = first.union(frame)
        return first

    def in_sets(df, which):
        return df.repartition("row").withColumn("set", F.explode(which)).alias("l")

    members = union([t.select("row", F.lit(bits[n]).alias("bit")) for n, t in tables.items()]).alias("m")
    in_set = (F.col("l.row") == F.col("m.row")) & (F.col("l.set").bitwiseAND(F.col("m.bit")) != 0)
    everything = union([t.select("row", "part", F.lit(bits[n]).alias("filter"), F.lit("removed").alias("kind")) for n, t in tables.items()])
    marked = [everything.join(ids, "row", "left_semi").withColumn("kind", F.lit(mark)) for mark, ids in marks.items()]
    without = F.filter(sets, lambda s: s.bitwiseAND(F.col("filter")) == 0)
    survivors = in_sets(rows.select("row", "part", F.lit(0).alias("filter"), F.lit("kept").alias("kind")), sets)
    candidates = in_sets(union([everything.select("row", "part", "filter", "kind"), *[m.select("row", "part", "filter", "kind") for m in marked]]), without)
    overlapping = in_sets(everything.withColumn("kind", F.lit("redundant")), without)
    keys = ["part", "kind", "filter", "set"]
    found = [survivors.join(members, in_set, "left_anti"), candidates.join(members, in_set, "left_anti"), overlapping.join(members, in_set, "left_semi")]
    return union([f.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for f in found])


def orders(names) -> list[tuple]:
    """(filter_order, step, filter bit, set before, set after) of every step of every order."""
    bits = {name: 1 << i for i, name in enumerate(names)}
    out = []
    for order in permutations(names):
        before = 0
        for step, name in enumerate(order, 1):
            out.append(("".join(order), step, bits[name], before, before | bits[name]))
            before |= bits[name]
    return out


def audit(rows: DataFrame, tables: dict[str, DataFrame], marks: dict[str, DataFrame]) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, `<mark>_lost`, shapley."""
    names = list(tables)
    found = materialize(counts(rows, tables, marks), "audit-counts")
    # A set of s filters comes before a given one in s! (k - 1 - s)! orders.
    ways = F.array(*[F.lit(factorial(s) * factorial(len(names) - 1 - s)) for s in range(len(names))])
    times = F.element_at(ways, F.bit_count("set").cast("int") + 1)
    shares = found.where("kind = 'removed'").groupBy("part", "filter").agg(F.sum(F.col("n") * times).alias("n"))
    found = found.union(shares.select("part", F.lit("shapley"), "filter", F.lit(0), "n"))
    # A few hundred counts per part, whatever the rows.
    entry = F.struct(F.concat_ws("/", "kind", "filter", "set"), "n")
    per_part = rows.select("part").distinct().join(found.groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("counts")), "part")

    def count(kind, bit, at):
        return F.coalesce(F.try_element_at("counts", F.concat_ws("/", F.lit(kind), bit, at)), F.lit(0)).cast("bigint")

    fields = ("filter_order", "step", "bit", "before", "after")
    steps = F.array(*[F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, line)]) for line in orders(names)])
    bit, before, none = F.col("bit"), F.col("before"), F.lit(0)
    others = F.lit((1 << len(names)) - 1) - bit
    return per_part.select("part", "counts", F.inline(steps)).select(
        "part",
        "filter_order",
        "step",
        count("kept", none, F.col("after")).alias("kept"),
        count("removed", bit, before).alias("removed"),
        count("redundant", bit, before).alias("redundant"),
        count("removed", bit, others).alias("unique_fails"),
        *[count(mark, bit, before).alias(f"{mark}_lost") for mark in marks],
        count("shapley", bit, none).alias("shapley"),
    )
