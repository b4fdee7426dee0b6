"""Command and change topics as sources and sinks.

With the Kafka connector on the class path ``format("kafka")`` gives exactly
the envelope schema; everywhere else the same envelope is read from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerweave.schemas import ENVELOPE


def read_stream(
    spark: SparkSession, brokers: str, topics: list[str], max_offsets: int | None = None
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics)).option("includeHeaders", "true")
        .option("startingOffsets", "earliest").option("failOnDataLoss", "true")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def read_batch(spark: SparkSession, brokers: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    return (
        spark.read.format("kafka").option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics)).option("includeHeaders", "true")
        .option("startingOffsets", starting).load()
    )


def read_files_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def topics(records: DataFrame, names: list[str]) -> DataFrame:
    """The records of the subscribed topics."""
    return records.filter(F.col("topic").isin(names))


def write_batch(records: DataFrame, brokers: str) -> None:
    records.select("key", "value", "topic", "headers").write.format("kafka").option(
        "kafka.bootstrap.servers", brokers).option("includeHeaders", "true").save()
