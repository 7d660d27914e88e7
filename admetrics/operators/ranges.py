"""Cutting ordered groups into ranges of equal size, so that no window partition holds a whole group.

A running total or a rank needs its group in order, and a plain window puts each group into one task. Here the rows get the number of a range of
the sort key (group, order, tie-break), whatever the groups. The borders between ranges are keys of sampled rows; there are at most ``MOST_RANGES``, and a
row finds its range by bisection among them, in an expression. So the number is a function of the row alone: it can be
computed again in another pass, and a task that runs again gives the same. Rows then go to the task of their range by one shuffle, and windows partitioned by
range and group need no other. What came before a range in its group is one row per border, a table that is small by construction.
"""

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from admetrics.operators.packing import send_packed
from admetrics.session import materialize, shuffles_freed

RANGE_ROWS = 1_000_000
#: Ranges at most, rows that make a range worth a task, and sampled keys for each range.
MOST_RANGES, LEAST_ROWS, SAMPLED = 4096, 10_000, 100
#: Tell rows with equal keys apart: a hash of the content, then a number.
TIE, ROW = "_tie", "_row"
OWN = (TIE, ROW)


def text_key(text) -> Column:
    """A non-null stand-in for a string that keeps NULL apart from every real value."""
    return F.coalesce(F.concat(F.lit("="), F.col(text)), F.lit(""))


def numbered(df: DataFrame) -> DataFrame:
    """The rows with their tie-break, stored, so that the numbers stay. The hash follows from the row and is not stored."""
    if ROW in df.columns:
        return df
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    with shuffles_freed(df.sparkSession):
        return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered").withColumn(TIE, content)


def range_count(spark, rows, range_rows=RANGE_ROWS) -> int:
    """Ranges of ``range_rows`` rows, or one for each task of a shuffle if that makes them smaller but still worth a task."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(MOST_RANGES, max(math.ceil(rows / range_rows), min(tasks, rows // LEAST_ROWS))))


@dataclass
class Ranges:
    """``count`` ranges of the sort key ``fields`` + tie-break, and the ``borders`` between them: the first key of each range but the first."""

    count: int
    fields: tuple
    schema: T.StructType
    borders: list

    @property
    def _nullable(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType) for f in self.schema])

    @property
    def _literal(self) -> Column:
        rows = [{f.name: v for f, v in zip(self.schema, b)} for b in self.borders]
        return F.from_json(F.lit(json.dumps(rows)), T.ArrayType(self._nullable))

    def number(self, df: DataFrame) -> DataFrame:
        """Adds ``_range``; ``df`` has the fields and the tie-break."""
        kept = df.columns
        # Of the borders' type, nullable fields and all: else the whole key is converted for each comparison.
        out = df.withColumns({"_key": F.struct(*self.fields, *OWN).cast(self._nullable), "_range": F.lit(0)})
        step = 1 << max(0, len(self.borders).bit_length() - 1)
        while step and self.borders:
            border = F.get(self._literal, F.col("_range") + (step - 1))
            out = out.withColumn("_range", F.col("_range") + F.when(border <= F.col("_key"), step).otherwise(0))
            step //= 2
        return out.select(*kept, "_range")

    def upper_border(self, field) -> Column:
        """A field of the border above a row's range, NULL in the last range."""
        return F.get(self._literal, F.col("_range")).getField(field)

    def dealt(self, df: DataFrame) -> DataFrame:
        """Each row in the task of its range."""
        return self.deal(self.number(df))

    def deal(self, numbered: DataFrame) -> DataFrame:
        """Rows that have their ``_range`` in the task of it."""
        return send_packed(numbered, lambda packed: packed.repartitionById(self.count, F.col("_range")))


def find_ranges(df: DataFrame, fields, rows, range_rows=RANGE_ROWS) -> Ranges:
    """Ranges of about equal size for the rows of a numbered frame."""
    spark = df.sparkSession
    n = range_count(spark, rows, range_rows)
    keys = df.select(*fields, *OWN)
    step = max(1, rows // (n * SAMPLED))
    sample = keys.where(F.pmod(F.xxhash64(*OWN), F.lit(step)) == 0)
    # At most about MOST_RANGES * SAMPLED keys, however large the table.
    place = Window.orderBy(*fields, *OWN)
    placed = sample.withColumns({"_place": F.row_number().over(place), "_all": F.count(F.lit(1)).over(Window.partitionBy())})
    each = F.ceil(F.col("_all") / n)
    borders = [] if n == 1 else placed.where((F.col("_place") > 1) & (F.pmod(F.col("_place") - 1, each) == 0)).drop("_place", "_all").collect()
    return Ranges(n, tuple(fields), keys.schema, sorted((tuple(b) for b in borders), key=_order))


def _order(key):
    """Spark's order of a key: NULL first, NaN last."""
    return [(v is not None, v != v, 0 if v is None or v != v else v.encode() if isinstance(v, str) else v) for v in key]
