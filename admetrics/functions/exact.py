"""Sums and means of doubles that do not depend on row order.

A double sum changes in its last bits with every partitioning. Here every finite value is added as an exact number, and the total is rounded to a
double once. Money is added as the decimal it is written with (the shortest one that gives the double again): values below 1e9 share one
decimal buffer with 18 places, and nearly all values do. A ratio is cut into units and units of 1e-18, a bigint and a decimal made from a bigint. Larger values go to
a second decimal buffer with 12 places, which a double of that size cannot use up, and what is no ordinary number to a plain double sum. All of them are plain
sums, so they run in generated code and combine map-side.

Limits: a total of values below 1e9 may reach 1e20; beyond, Spark reports an overflow and gives no wrong sum. Digits below 1e-18 are
dropped. Values of 1e22 and more, infinities and NaN are added as plain doubles.
"""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = 6
RATIO = 18
#: What a total of money consists of: decimals of ordinary and of large values, plain doubles of the others.
PARTS = {"main": "decimal(38,18)", "high": "decimal(38,12)", "odd": "double"}
_LARGE_FROM = 1e9
_RATIO_LARGE_FROM = 1e8
_ODD_FROM = 1e22
_PIECE = 1_000_000


def _add(*terms: Column) -> Column:
    """Sum of the terms that are not NULL; NULL if none is."""
    total = terms[0]
    for term in terms[1:]:
        total = F.coalesce(total + term, total, term)
    return total


def _large(x: Column, start) -> dict[str, Column]:
    size = F.abs(x)
    return {
        "high": F.when((size >= start) & (size < _ODD_FROM), x).cast(PARTS["high"]),
        "odd": F.when(F.isnan(x) | (size >= _ODD_FROM), x),
    }


def _sums(values: dict, window) -> dict[str, Column]:
    sums = {name: F.sum(value) for name, value in values.items()}
    return sums if window is None else {name: total.over(window) for name, total in sums.items()}


def money_parts(x: Column) -> dict[str, Column]:
    """What one value of money adds to the parts of a total; at most one of them is not NULL."""
    return {"main": F.when(F.abs(x) < _LARGE_FROM, x).cast(PARTS["main"]), **_large(x, _LARGE_FROM)}


def total_parts(x: Column, window=None) -> dict[str, Column]:
    """The parts of a total of money as aggregates or window functions; each is NULL where nothing falls into it."""
    return _sums(money_parts(x), window)


def add_parts(*parts: dict[str, Column]) -> dict[str, Column]:
    """The parts of the sum of several totals."""
    return {name: _add(*[p[name] for p in parts]).cast(kind) for name, kind in PARTS.items()}


def sum_parts(parts: dict[str, Column], window) -> dict[str, Column]:
    """Totals of stored parts over a window."""
    return {name: F.sum(parts[name]).over(window).cast(kind) for name, kind in PARTS.items()}


def as_double(parts: dict[str, Column]) -> Column:
    main, high, odd = (parts[name] for name in PARTS)
    both = F.coalesce(main.cast(PARTS["high"]) + high, high).cast("double")
    exact = F.when(high.isNull(), main.cast("double")).otherwise(both)
    return F.coalesce(exact + odd, exact, odd)


def _ratio_sum(x: Column, window) -> Column:
    """Each value to 18 places: its units, and three times six digits as one bigint."""
    small = F.when(F.abs(x) < _RATIO_LARGE_FROM, x)
    units = F.floor(small)
    pieces, rest = [], small - units
    for last in (False, False, True):
        rest = rest * _PIECE
        piece = F.floor(rest + 0.5 if last else rest)
        rest = rest - piece
        pieces.append(piece)
    low = (pieces[0] * _PIECE + pieces[1]) * _PIECE + pieces[2]
    sums = _sums({"units": units, "low": low.cast("decimal(20,0)"), **_large(x, _RATIO_LARGE_FROM)}, window)
    places = (sums["units"].cast("decimal(19,0)") * F.lit(Decimal(10) ** 18) + sums["low"]).cast("decimal(38,0)")
    main, high, odd = F.concat(places.cast("string"), F.lit("E-18")), sums["high"], sums["odd"]
    exact = F.when(high.isNull(), main.cast("double")).otherwise(F.coalesce(main.cast(PARTS["high"]) + high, high).cast("double"))
    return F.coalesce(exact + odd, exact, odd)


def exact_sum(x: Column, digits: int = MONEY, window=None) -> Column:
    return as_double(total_parts(x, window)) if digits == MONEY else _ratio_sum(x, window)


def exact_mean(x: Column, digits: int = RATIO, window=None) -> Column:
    n = F.count(x) if window is None else F.count(x).over(window)
    return exact_sum(x, digits, window) / F.nullif(n, F.lit(0))
