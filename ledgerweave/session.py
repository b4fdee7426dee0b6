"""Session settings, and the one way this library cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a repeated JSON key keeps its last value instead of failing the document
    "spark.sql.variant.allowDuplicateKeys": "true",
    # the JVM does not compile methods beyond 8000 bytes of code; wide projections
    # run faster as many small methods than as one stage-wide interpreted one
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a step that has been written or answered leaves no shuffle files behind for the steps after it
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # files of ids and places in order are a small part of their rows (measured: 1/30 and less), and a table is sent to
    # every task, through the driver, by what its rows take there
    "spark.sql.sources.fileCompressionFactor": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator here relies on."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A private folder is made only where none is named *and* the session is a
    local one, so that a cluster never writes to a machine-local disk.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="ledgerweave-")
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def spread(df: DataFrame, by: str, source: DataFrame) -> DataFrame:
    """Narrow rows ahead of costly work on each, dealt over four tasks a core, so that no core waits long for the last one.

    A number that is named is kept, where a shuffle's own partitions would be merged to about one a core.
    """
    tasks = max(4 * df.sparkSession.sparkContext.defaultParallelism, source.rdd.getNumPartitions())
    return df.repartition(tasks, by)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike ``checkpoint()`` the result keeps column pruning and filter
    pushdown, and like it the result survives the loss of any executor.
    """
    path = f"{shared_folder(df.sparkSession)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
