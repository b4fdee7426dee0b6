"""Where a sink's messages go: dead letters and results, behind one seam.

A writer gets records and the batch number and returns only once they are safe.
What a step has delivered is marked, so a batch that runs again after a crash
repeats the step it died in and none before it: messages may come twice, and are
never lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Writer = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Outbox:
    results: Writer
    dlq: Writer


def folders(root: str) -> Outbox:
    """One directory a batch for each kind of message; a repeated batch overwrites its own."""
    def to(name: str) -> Writer:
        return lambda records, batch: records.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")

    return Outbox(results=to("results"), dlq=to("dlq"))


def topics(servers: str, **options: str) -> Outbox:
    """Kafka topics, named by the records themselves; ``acks`` defaults to all replicas."""
    def write(records: DataFrame, _batch: int) -> None:
        columns = [c for c in ("key", "value", "topic", "headers") if c in records.columns]
        sender = records.select(*columns).write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
        if "headers" in columns:
            sender = sender.option("includeHeaders", "true")
        sender.options(**options).save()

    return Outbox(results=write, dlq=write)


def deliver(spark: SparkSession, root: str, step: str, batch: int, send: Callable[[], None]) -> None:
    """Send once a batch and step, unless it is marked as delivered."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/delivered/{step}-{batch}")
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        send()
        files.create(at, True).close()
