"""Batch writers. All of them write in parallel; none passes the data through the driver or one task."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admetrics.operators.packing import send_packed
from admetrics.session import shuffles_freed

def rebalanced(df: DataFrame, partition_by, derived=None) -> DataFrame:
    """Rows gathered for a partitioned write. ``derived``: columns that follow from the others of a row; they are worked out behind the shuffle."""
    sent = send_packed(df.drop(*(derived or ())), lambda packed: packed.hint("rebalance", *partition_by), partition_by)
    return sent.withColumns(derived or {}).select(*df.columns)


def write_table(df: DataFrame, base, name, fmt="parquet", partition_by=(), derived=None, gathered=False) -> str:
    """Full overwrite of a table by path.

    For a partitioned table the rows are first rebalanced on the partition columns: adaptive execution
    splits a partition that is too large for one file and joins those that are too small. ``derived`` is that of `rebalanced`.
    ``gathered``: the rows of a partition lie in few tasks already.
    """
    path = f"{base}/{name}"
    if partition_by and not gathered:
        df = rebalanced(df, partition_by, derived)
    stored = {"compression": "zstd"} if fmt == "parquet" else {}
    with shuffles_freed(df.sparkSession):
        df.write.format(fmt).mode("overwrite").options(**stored).partitionBy(*partition_by).save(path)
    return path


#: Rows of a compressed text file at most: one task reads it whole.
FILE_ROWS = 1_000_000


def write_events_json(df: DataFrame, path) -> None:
    """JSON lines as gzip: the names of the fields come again in every line and take a fraction of their size."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(path)


def export_csv(df: DataFrame, directory, name, compression="none") -> str:
    """CSV with a header in every part file; the number of parts follows the data."""
    path = f"{directory}/{name}"
    rows = {} if compression == "none" else {"maxRecordsPerFile": FILE_ROWS}
    df.write.mode("overwrite").options(header=True, compression=compression, **rows).csv(path)
    return path


def to_kafka_messages(df: DataFrame) -> DataFrame:
    """Key ``campaign_id#date`` and the row as JSON, both binary."""
    return df.select(
        F.concat_ws("#", "campaign_id", F.col("date").cast("string")).cast("binary").alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )


#: Takes a fifth off messages for little more time. Not for tables of many small files, where starting each column at this level costs more than all else.
_MESSAGES = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def write_messages(messages: DataFrame, path, mode="errorifexists") -> None:
    """Messages to files, in place of a broker."""
    with shuffles_freed(messages.sparkSession):
        messages.write.mode(mode).options(**_MESSAGES).parquet(path)


def write_kafka(df: DataFrame, servers, topic, **options) -> None:
    """Events to a topic; needs Spark's Kafka package on the class path."""
    writer = to_kafka_messages(df).write.format("kafka")
    writer.options(**{"kafka.bootstrap.servers": servers, "topic": topic, **options}).save()


def register_table(spark: SparkSession, name, path, fmt="parquet", partitioned=False) -> None:
    """An external table over existing files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    if partitioned and fmt != "delta":
        spark.catalog.recoverPartitions(name)
