"""Stream sources of Kafka-shaped records, and the line-list reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import KAFKA_RECORD

# Columns a record file carries: the Kafka record plus its arrival order.
RECORD_FILE_SCHEMA = "seq BIGINT, arrival_ms BIGINT, timestamp BIGINT, key BINARY, value BINARY, partition INT"


KAFKA_ORDER = ("arrival_ms", "partition", "offset")


def from_kafka_frame(df: DataFrame) -> DataFrame:
    """Map the Kafka connector's columns to the record shape: its TIMESTAMP
    (append time) becomes ``arrival_ms`` and the event time ``timestamp`` in
    epoch ms. Offsets only order records inside one partition, so arrival
    order is ``KAFKA_ORDER``; the late tagger ranks it per micro-batch."""
    ms = F.unix_millis(F.col("timestamp"))
    return df.select(ms.alias("arrival_ms"), ms.alias("timestamp"), "key", "value",
                     "partition", "offset")


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str, **options) -> DataFrame:
    """Production source: ``readStream.format("kafka")``. Needs the Kafka
    connector package on the classpath (not bundled with PySpark)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic))
    for key, value in options.items():
        reader = reader.option(key, value)
    return from_kafka_frame(reader.load())


def read_record_files(spark: SparkSession, path: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of record files (one file per producer flush). The file source
    orders new files by modification time."""
    reader = spark.readStream.format(fmt).schema(RECORD_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_lines(spark: SparkSession, path: str, column: str = "name") -> DataFrame:
    """One value per line of a text file (the city list), every line as it is."""
    return spark.read.text(path).select(F.col("value").alias(column))


__all__ = ["KAFKA_ORDER", "KAFKA_RECORD", "RECORD_FILE_SCHEMA", "from_kafka_frame", "read_kafka",
           "read_record_files", "read_lines"]
