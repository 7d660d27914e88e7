"""Labels and scaling: channel types, tiers, marker sizes."""

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admetrics.schemas import CHANNEL_TYPES


def channel_type(name) -> Column:
    """By the first matching part of the name; anything else counts as a story placement."""
    name = F.col(name) if isinstance(name, str) else name
    return (
        F.when(name.contains("Search"), "search")
        .when(name.contains("Display"), "display")
        .when(name.contains("Feed"), "social_feed")
        .otherwise("social_story")
    )


def channel_type_lookup(df: DataFrame, mapping=None, name="channel_name") -> DataFrame:
    """By exact name from a fixed map; an unknown name gives NULL."""
    pairs = chain.from_iterable((mapping or CHANNEL_TYPES).items())
    lookup = F.create_map(*[F.lit(x) for x in pairs])
    return df.withColumn("channel_type", F.try_element_at(lookup, F.col(name)))


def roas_tier(roas) -> Column:
    roas = F.col(roas) if isinstance(roas, str) else roas
    return F.when(roas >= 2, "good").when(roas >= 1.5, "fair").otherwise("poor")


def scale_to_max(x, mul=600.0, add=80.0) -> Column:
    """Scale to the largest value of the frame. For aggregated frames only: one window over all rows."""
    x = F.col(x) if isinstance(x, str) else x
    return x / F.nullif(F.max(x).over(Window.partitionBy()), F.lit(0)) * mul + add

