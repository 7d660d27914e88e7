"""Guarded ratios, percentages, rounding."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def guarded(num, den, default=0.0) -> Column:
    """``num / den`` where the denominator is positive, else the default (also for NULL)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def floor_ratio(num, den, eps=1e-9) -> Column:
    """``num / max(den, eps)``: a zero denominator gives a huge number, not zero."""
    return _col(num) / F.greatest(_col(den), F.lit(eps))


def null_ratio(num, den) -> Column:
    """``num / den``, NULL for a zero denominator."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def divide(num, den, alternate=0.0) -> Column:
    """``num / den``, the alternate result for a zero or missing denominator or numerator."""
    return F.coalesce(null_ratio(num, den), F.lit(alternate))


def pct(num, den, places=2) -> Column:
    return F.round(null_ratio(_col(num) * 100.0, den), places)


def exact_round(x, places) -> Column:
    """Half-up on the shortest decimal form of the double, as Spark rounds: 0.03075 goes to 0.0308."""
    return F.round(_col(x), places)


def metric_columns(conversion_rate=True) -> dict:
    """The row ratios: ctr, cpc, roas and, on request, conversion_rate."""
    ratios = {
        "ctr": guarded("clicks", "impressions"),
        "cpc": guarded("spend_usd", "clicks"),
        "roas": guarded("revenue_usd", "spend_usd"),
    }
    if conversion_rate:
        ratios["conversion_rate"] = guarded("conversions", "clicks")
    return ratios


def with_metrics(df: DataFrame, conversion_rate=True) -> DataFrame:
    return df.withColumns(metric_columns(conversion_rate))


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
