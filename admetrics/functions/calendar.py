"""Dates: parsing, calendar attributes, day and month ordinals."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stands for a missing date in integer day numbers; real ones lie within +-3,000,000.
NO_DAY = -1_000_000_000


def parse_date(df: DataFrame, name="date") -> DataFrame:
    """String to date; an unreadable value becomes NULL instead of failing the job."""
    return df.withColumn(name, F.try_to_date(F.col(name)))


def day_ordinal(date) -> Column:
    """Days since 1970-01-01, free of time zones and clock changes; missing dates sort first."""
    return F.coalesce(F.unix_date(_col(date)), F.lit(NO_DAY))


def calendar_columns(date="date") -> dict:
    d = _col(date)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "week": F.weekofyear(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
        "date_key": F.date_format(d, "yyyyMMdd").cast("int"),
    }


def calendar(df: DataFrame, date="date") -> DataFrame:
    return df.withColumns(calendar_columns(date))


def iso_year(date) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(date))


def month_start(date) -> Column:
    return F.trunc(_col(date), "month")


def month_label(date) -> Column:
    return F.date_format(_col(date), "yyyy-MM")


def month_ordinal(date) -> Column:
    """Consecutive month number, so that the month before is one less."""
    d = _col(date)
    return F.year(d) * 12 + F.month(d)


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
