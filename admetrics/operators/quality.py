"""Row checks, benchmark bands and star-schema checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admetrics.functions.ratios import with_metrics
from admetrics.operators.ranges import RANGE_ROWS
from admetrics.schemas import (
    BENCHMARK_BANDS,
    BENCHMARK_COLUMNS,
    CAMPAIGN_TYPES,
    CHANNELS,
    PLATFORMS,
    RAW,
)
from admetrics.session import materialize

MEASURES = ["impressions", "clicks", "conversions", "spend_usd", "revenue_usd"]
DOMAINS = {"campaign_type": CAMPAIGN_TYPES, "platform": PLATFORMS, "channel": CHANNELS}


def with_reasons(df: DataFrame, domains=False) -> DataFrame:
    """Adds the array ``reasons``; a row without any is valid."""
    reasons = [F.when(F.col(name).isNull(), f"{name} is missing") for name in RAW.names]
    for name in MEASURES:
        value = F.col(name)
        reasons.append(F.when(value < 0, f"{name} is negative"))
        reasons.append(F.when(F.isnan(value.cast("double")), f"{name} is not a number"))
    unreadable = F.col("date").isNotNull() & F.try_to_date(F.col("date")).isNull()
    reasons.append(F.when(unreadable, "date is unreadable"))
    if domains:
        for name, allowed in DOMAINS.items():
            reasons.append(F.when(~F.col(name).isin(allowed), f"{name} is unknown"))
    return df.withColumn("reasons", F.array_compact(F.array(*reasons)))


def split_valid(df: DataFrame, domains=False):
    """The valid rows, and the others with their reasons."""
    checked = with_reasons(df, domains)
    good = checked.where(F.size("reasons") == 0).drop("reasons")
    return good, checked.where(F.size("reasons") > 0)


#: Repeated ids up to which the other rows are told by joins, which Spark can broadcast.
FEW_IDS = 100_000


def split_repeated(df: DataFrame, few=FEW_IDS, most=RANGE_ROWS):
    """The rows with each ``event_id`` once, and what was set aside: (event_id, copies, reasons).

    Ids that occur once pass without their content being compared. Of the rows of a repeated id the one with the smallest content stays, which the tasks
    find for their own rows first, so an id with a third of all rows is no hot group. Rows without an id have no identity and all stay.

    Where more than ``few`` ids are repeated, none of them more than ``most`` times, two joins would send and sort all rows twice: the rows are dealt by id once
    and reduced where they are.
    """
    named = df.where("event_id IS NOT NULL")
    repeated = materialize(named.groupBy("event_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "repeated-ids")
    rest = [c for c in df.columns if c != "event_id"]

    def smallest(rows):
        return rows.groupBy("event_id").agg(F.min(F.struct(*rest)).alias("_row")).select("event_id", "_row.*").select(*df.columns)

    ids = repeated.select("event_id")
    n_ids, copies = repeated.agg(F.count(F.lit(1)), F.max("_n")).first()
    if n_ids > few and copies <= most:
        kept, once = smallest(named.repartition("event_id")), df.where("event_id IS NULL")
    else:
        # The aggregate combines before the shuffle.
        kept, once = smallest(named.join(ids, "event_id", "left_semi")), df.join(ids, "event_id", "left_anti")
    aside = repeated.select("event_id", (F.col("_n") - 1).alias("copies"), F.array(F.lit("event_id is repeated")).alias("reasons"))
    return once.unionByName(kept), aside


def benchmark_bands(df: DataFrame, bands=None) -> DataFrame:
    """Per channel the share of rows whose ratios lie within the published ranges."""
    bands = df.sparkSession.createDataFrame(bands or BENCHMARK_BANDS, BENCHMARK_COLUMNS)
    ratios = {"ctr": "ctr", "cpc": "cpc", "cvr": "conversion_rate", "roas": "roas"}
    shares = []
    for short, name in ratios.items():
        inside = F.col(name).between(F.col(f"{short}_low"), F.col(f"{short}_high"))
        shares.append((F.count_if(inside) / F.count(F.lit(1))).alias(f"{short}_in_band"))
    # The band table is the fixed list above (or the caller's list), one row per channel.
    return (
        with_metrics(df)
        .join(F.broadcast(bands), "channel")
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("row_count"), *shares)
    )


def star_report(fact: DataFrame, dims: dict) -> DataFrame:
    """Row count, facts without a dimension row, and natural keys that occur more than once.

    The fact is counted per key triple first; only those counts meet the dimensions.
    """
    keys = {"campaign": "campaign_key", "channel": "channel_key", "date": "date_key"}
    natural = {"campaign": "campaign_id", "channel": "channel_name", "date": "full_date"}
    facts = fact.groupBy(*keys.values()).agg(F.count(F.lit(1)).alias("n"))
    for name, key in keys.items():
        known = dims[f"dim_{name}"].select(key).distinct().withColumn(f"has_{name}", F.lit(True))
        facts = facts.join(known, key, "left")

    def rows(where=None):
        counted = F.col("n") if where is None else F.when(where, F.col("n"))
        return F.coalesce(F.sum(counted), F.lit(0))

    totals = facts.agg(
        rows().alias("fact rows"),
        *[rows(F.col(f"has_{name}").isNull()).alias(f"facts without {name}") for name in keys],
    )
    report = totals.unpivot([], totals.columns, "check", "n")
    for name, column in natural.items():
        repeated = (
            dims[f"dim_{name}"]
            .groupBy(column)
            .count()
            .where("count > 1")
            .agg(F.lit(f"repeated {column}").alias("check"), F.count(F.lit(1)).alias("n"))
        )
        report = report.unionByName(repeated)
    return report
