"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send functions of ``module`` to executors by value, so that they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches_of(spark: SparkSession, rows: int = 1000) -> None:
    """Rows that Python workers get at once: with whole texts few, so that their memory stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def id_text(column: str = "doc_id") -> Column:
    """The id as text; a null id counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``: which fold a document is in."""
    return F.crc32(id_text(column)) % modulus


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names, whatever their case: results take their place."""
    taken = {n.lower() for n in names}
    keep = [c for c in df.columns if c.lower() not in taken]
    return df.select(*[F.col(f"`{c}`") for c in keep]) if len(keep) < len(df.columns) else df


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (20, 09 to 0D), A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_counts(batches):
    """(word, n) of the column text: partial counts, handed on whenever many words have come together."""
    import pandas as pd

    counts: Counter = Counter()
    for pdf in batches:
        for t in pdf["text"]:
            counts.update(words(t))
            if len(counts) > 250_000:
                yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                counts.clear()
    if counts:
        yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})


def runs(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges over consecutive items whose sizes sum to ``most`` at most, or of one larger item."""
    start, total, end = 0, 0, 0
    for end, size in enumerate(sizes):
        if end > start and total + size > most:
            yield start, end
            start, total = end, 0
        total += size
    if total or start <= end:
        yield start, end + 1


class Shared:
    """A broadcast of any object: sent once to each executor, opened once in each task."""

    def __init__(self, spark: SparkSession, value) -> None:
        self._sent, self._opened = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"_sent": self._sent, "_opened": None}

    @property
    def value(self):
        if self._opened is None:
            self._opened = cloudpickle.loads(self._sent.value)
        return self._opened


def vectorised(kind: str) -> Callable:
    """A function of pandas columns as a Spark function of this type; made when used, so a session may come later."""
    return lambda f: lambda *columns: F.pandas_udf(f, kind)(*columns)
