"""Clustered rewrite of a table along a Z-order curve."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 10


def count_up_to(marks: str, value: str) -> Column:
    """How many entries of a sorted array column are at most ``value``, by binary search over 2 ** BITS entries at most."""
    middle = "shiftright(span.low + span.high, 1)"
    return F.expr(
        f"""
        aggregate(
          sequence(1, {BITS + 1}),
          named_struct('low', 0, 'high', size({marks})),
          (span, step) -> CASE
            WHEN span.low >= span.high THEN span
            WHEN get({marks}, {middle}) <= {value}
              THEN named_struct('low', {middle} + 1, 'high', span.high)
            ELSE named_struct('low', span.low, 'high', {middle}) END,
          span -> span.low)
        """
    )


def with_count_up_to(df: DataFrame, marks: str, value: Column, name: str) -> DataFrame:
    """Adds the same count as a column, found by halving steps that are one plain expression each, so they run in generated code."""
    out = df.withColumn(name, F.lit(0))
    for step in (2**k for k in reversed(range(BITS))):
        mark = F.get(F.col(marks), F.col(name) + (step - 1))
        out = out.withColumn(name, F.col(name) + F.when(mark <= value, step).otherwise(0))
    return out


def z_value(columns) -> Column:
    """Interleaves the low ``BITS`` bits of the columns; the first column gives the highest bit."""
    bits = []
    for position in range(BITS):
        for place, column in enumerate(columns):
            target = position * len(columns) + len(columns) - 1 - place
            bit = F.shiftright(column.cast("long"), position).bitwiseAND(F.lit(1).cast("long"))
            bits.append(F.shiftleft(bit, target))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def with_z_order(df: DataFrame, columns) -> DataFrame:
    """Adds ``_z`` over numeric columns.

    Each column counts by its rank among 1,023 quantiles, so skewed values spread evenly. The quantiles
    are all that reaches the driver.
    """
    steps = 2**BITS
    fractions = [i / steps for i in range(1, steps)]
    quantiles = df.approxQuantile(columns, fractions, 0.25 / steps)
    # One literal each: building 1,023 columns from Python would take longer than the sort.
    arrays = {c: ", ".join(f"double('{x!r}')" for x in marks) for c, marks in zip(columns, quantiles)}
    out = df.withColumns({f"_marks_{c}": F.expr(f"array({text})") for c, text in arrays.items()})
    for c in columns:
        out = with_count_up_to(out, f"_marks_{c}", F.col(c).cast("double"), f"_rank_{c}")
    return out.withColumn("_z", z_value([F.col(f"_rank_{c}") for c in columns])).select(*df.columns, "_z")


def clustered(df: DataFrame, columns, spread_by=None, n_ranges=None) -> DataFrame:
    """Rows in ranges of the curve, sorted within each.

    Without ``n_ranges`` Spark sets the number: its shuffle partitions, joined by size under adaptive execution. ``spread_by``
    (a column that tells rows apart) lets one crowded point of the curve fill several ranges.
    """
    order = [F.col("_z")] + ([F.xxhash64(spread_by)] if spread_by else [])
    marked = with_z_order(df, columns)
    ranged = marked.repartitionByRange(n_ranges, *order) if n_ranges else marked.repartitionByRange(*order)
    return ranged.sortWithinPartitions("_z").drop("_z")


def rewrite_clustered(df: DataFrame, columns, path, spread_by=None, n_ranges=None, fmt="parquet") -> str:
    """Writes the clustered rows to another path than the table being read, which stays as it is."""
    clustered(df, columns, spread_by, n_ranges).write.format(fmt).mode("overwrite").save(path)
    return path
