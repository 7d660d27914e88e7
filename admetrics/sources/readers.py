"""Batch and stream readers. Schemas are given, never inferred."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admetrics.schemas import RAW

MESSAGES = "key binary, value binary"


def read_events_json(spark: SparkSession, path, mode="PERMISSIVE") -> DataFrame:
    """One JSON object per line; in PERMISSIVE mode a bad line or value becomes NULL."""
    return spark.read.schema(RAW).option("mode", mode).json(path)


def read_table(spark: SparkSession, base, name, fmt="parquet", schema=None) -> DataFrame:
    """A table by its path. With a schema its types and column order hold, also for partition columns."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    df = reader.load(f"{base}/{name}")
    return df if schema is None else df.select(*schema.names)


def read_mart_csv(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def kafka_options(servers, topic, **options) -> dict:
    """Options of the stream source: from the earliest offset.

    When the broker has dropped offsets that were not read yet, the stream fails, unless ``failOnDataLoss="false"`` is passed.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **options,
    }


def kafka_sasl_options(connection_string) -> dict:
    """Options for a broker that takes a connection string over SASL_SSL."""
    login = (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        f'username="$ConnectionString" password="{connection_string}";'
    )
    return {
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.jaas.config": login,
    }


def read_events_kafka(spark: SparkSession, servers, topic, **options) -> DataFrame:
    """The message stream; needs Spark's Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def read_messages_files(spark: SparkSession, path, max_files=None) -> DataFrame:
    """A stream of stored messages (binary ``key`` and ``value``), in place of a broker."""
    reader = spark.readStream.schema(MESSAGES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def parse_events(messages: DataFrame) -> DataFrame:
    """Message value to raw columns."""
    event = F.from_json(F.col("value").cast("string"), RAW)
    return messages.select(event.alias("event")).select("event.*")
