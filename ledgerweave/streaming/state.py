"""State of a sink that outlives its micro-batches: keyed tables and an index of seen ids.

Both are folders of Parquet in the ledger's own root. What batch n writes is
overwritten when n runs again, and n reads only what batches before it wrote, so
a crash anywhere leaves nothing behind that counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` that a finished write left; none where there is no such path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    done = lambda s: files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    return [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory() and done(s)]


def numbers(names: list[str], kind: str) -> list[int]:
    return sorted(int(n.removeprefix(f"{kind}=")) for n in names if n.startswith(f"{kind}="))


@dataclass(frozen=True)
class KeyedTable:
    """The latest row of every key: one delta a batch, and a base every ``every`` batches.

    Reading takes the newest base and the deltas after it, so it costs what the
    keys cost, however long the history. A row whose ``gone`` is true ends its key.
    """

    path: str
    key: str
    schema: str
    every: int = 16

    def read(self, spark: SparkSession, before: int, wanted: DataFrame | None = None) -> DataFrame:
        """State ahead of batch ``before``; of the keys of ``wanted`` only, where given."""
        names = children(spark, self.path)
        base = max((n for n in numbers(names, "base") if n < before), default=None)
        deltas = [n for n in numbers(names, "delta") if n < before and (base is None or n > base)]
        paths = [f"{self.path}/delta={n}" for n in deltas] + ([f"{self.path}/base={base}"] if base is not None else [])
        full = f"batch bigint, gone boolean, {self.schema}"
        if not paths:
            return spark.createDataFrame([], full).drop("batch", "gone")
        rows = spark.read.schema(full).parquet(*paths)
        if wanted is not None:
            rows = rows.join(wanted.select(self.key).distinct(), self.key, "left_semi").select(*rows.columns)
        columns = [c for c in rows.columns if c != self.key]
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*columns), "batch").alias("row")).select(self.key, "row.*")
        return last.filter("not gone").select(*[c for c in rows.columns if c not in ("batch", "gone")])

    def write(self, rows: DataFrame, batch: int, gone: str = "false") -> None:
        """What batch ``batch`` changed; one row a key."""
        columns = [f"cast({name} as {kind}) as {name}" for name, kind in (f.split(" ", 1) for f in _fields(self.schema))]
        rows.selectExpr(f"{batch}L as batch", f"{gone} as gone", *columns).write.mode("overwrite").parquet(f"{self.path}/delta={batch}")
        base = max((n for n in numbers(children(rows.sparkSession, self.path), "base") if n < batch), default=-1)
        if batch - base >= self.every:
            self.read(rows.sparkSession, batch + 1).selectExpr(f"{batch}L as batch", "false as gone", "*").write.mode("overwrite").parquet(
                f"{self.path}/base={batch}")


def _fields(schema: str) -> list[str]:
    """Top-level fields of a schema text."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            out.append(schema[start:i].strip())
            start = i + 1
    return out


@dataclass(frozen=True)
class SeenIds:
    """Which ids any earlier batch posted: Bloom filters in generations of fixed size.

    An id that was never posted is told so, but for about one in 50,000; one that
    was is always found. A batch reads ``buckets`` rows a generation and writes one
    generation, whatever was posted before; a full generation is sealed and a new
    one begun. The ids it suspects are looked up exactly by the caller.
    """

    path: str
    buckets: int = 64
    bits: int = 1 << 20
    bits_per_id: int = 24
    hashes: int = 10

    @property
    def capacity(self) -> int:
        return self.buckets * self.bits // self.bits_per_id

    def generations(self, spark: SparkSession, before: int) -> dict[int, int]:
        """The newest version of each generation ahead of batch ``before``."""
        found: dict[int, int] = {}
        for name in children(spark, self.path):
            generation, batch = map(int, name.split("-"))
            if batch < before:
                found[generation] = max(batch, found.get(generation, -1))
        return found

    def _filters(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        schema = "bucket int, n bigint, bits binary"
        paths = [f"{self.path}/{g}-{b}" for g, b in versions.items()]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _hashed(self, ids: DataFrame) -> DataFrame:
        return ids.select("id").distinct().selectExpr(
            "id", f"cast(pmod(xxhash64(id, 7L), {self.buckets}) as int) as bucket", "xxhash64(id) as one", "xxhash64(id, 1L) as two")

    def suspected(self, ids: DataFrame, before: int) -> DataFrame:
        """Those of ``ids`` that may have been posted ahead of batch ``before``."""
        spark = ids.sparkSession
        versions = self.generations(spark, before)
        if not versions:
            return ids.select("id").limit(0)
        return self._hashed(ids).groupBy("bucket").cogroup(self._filters(spark, versions).groupBy("bucket")).applyInPandas(
            _probe(self.bits, self.hashes), "id string")

    def add(self, ids: DataFrame, batch: int) -> None:
        """Ids of batch ``batch``, into the open generation or, where that is full, into a new one."""
        spark = ids.sparkSession
        versions = self.generations(spark, batch)
        open_, held = max(versions, default=0), spark.createDataFrame([], "bucket int, n bigint, bits binary")
        if versions:
            held = self._filters(spark, {open_: versions[open_]})
            if (held.agg(F.sum("n")).first()[0] or 0) >= self.capacity:
                open_, held = open_ + 1, held.limit(0)
        grown = self._hashed(ids).groupBy("bucket").cogroup(held.groupBy("bucket")).applyInPandas(
            _grown(self.bits, self.hashes), "bucket int, n bigint, bits binary")
        grown.write.mode("overwrite").parquet(f"{self.path}/{open_}-{batch}")


def _places(one, two, bits: int, hashes: int) -> Iterator[np.ndarray]:
    """The places of each id's marks, one array a hash function."""
    a, b = one.to_numpy(np.int64).view(np.uint64), two.to_numpy(np.int64).view(np.uint64) | np.uint64(1)
    for i in range(hashes):
        with np.errstate(over="ignore"):
            yield (a + np.uint64(i) * b) % np.uint64(bits)


def _probe(bits: int, hashes: int):
    def run(ids, filters):
        import pandas as pd

        known = np.zeros(len(ids), bool)
        marks = list(_places(ids["one"], ids["two"], bits, hashes))
        for held in filters["bits"]:
            table = np.frombuffer(held, np.uint8)
            known |= np.logical_and.reduce([(table[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 for p in marks]).astype(bool)
        return pd.DataFrame({"id": ids["id"][known]})

    return _local(run)


def _grown(bits: int, hashes: int):
    def run(key, ids, held):
        import pandas as pd

        table = np.frombuffer(held["bits"].iloc[0], np.uint8).copy() if len(held) else np.zeros(bits // 8, np.uint8)
        for p in _places(ids["one"], ids["two"], bits, hashes):
            np.bitwise_or.at(table, (p >> np.uint64(3)).astype(np.int64), np.left_shift(1, (p & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        n = int(held["n"].sum()) + len(ids)
        return pd.DataFrame({"bucket": [key[0]], "n": [n], "bits": [table.tobytes()]})

    return _local(run)


def _local(function):
    """A function of this module for workers that need not have this package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return function
