"""Ordered scans that never put a whole key, or the whole table, into one task.

A running sum or a look at the previous row is done in two levels: rows are
grouped into buckets of bounded size along their order, each bucket is reduced
to one row, the few bucket rows are scanned, and the result is added back to
the rows of their bucket. A key that holds a third of all rows is then spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from ledgerweave.session import stage

BUCKET = 1 << 16
#: Buckets between measured quantiles, at most.
MAX_BUCKETS = 128


def dense(order: str) -> str:
    """Buckets by value, for an order that has few gaps, such as the offsets of a topic partition."""
    return f"{order} div {BUCKET}"


def _bucketed(df: DataFrame, keys: list[str], order: str, bucket: str | None) -> DataFrame:
    """Add ``_b``: without a bucket of the caller's, between quantiles, so that gaps in the order do not matter.

    Any borders give the right result; those of whole numbers are measured on
    the order column alone, so that no row moves for them. Other orders go by rank.
    """
    if bucket:
        return df.withColumn("_b", F.expr(bucket))
    if isinstance(df.schema[order].dataType, IntegralType):
        return df.withColumn("_b", F.expr(f"if(`{order}` is null, -1, {_place(f'`{order}`', _cuts(df, order))})"))
    return number_rows(df, [*keys, order], "_rank").withColumn("_b", F.expr(dense("_rank"))).drop("_rank")


def _cuts(df: DataFrame, order: str) -> list[int]:
    """Borders between buckets, one a bucket: fewer for a small table, none for one of a single bucket."""
    steps = [i / MAX_BUCKETS for i in range(1, MAX_BUCKETS)]
    n, cuts = df.agg(F.count(order), F.percentile_approx(order, steps, 20 * MAX_BUCKETS)).first()
    return sorted(set((cuts or [])[:: max(1, MAX_BUCKETS * BUCKET // max(1, n))])) if n > BUCKET else []


def _place(order: str, cuts: list[int], first: int = 0) -> str:
    """SQL text of the number of ``cuts`` (sorted) that do not exceed the order, by halving."""
    if not cuts:
        return str(first)
    half = len(cuts) // 2
    below, above = _place(order, cuts[:half], first), _place(order, cuts[half + 1:], first + half + 1)
    return f"if({order} < {cuts[half]}L, {below}, {above})"


def number_rows(df: DataFrame, order: list[str], out: str = "rn", keep: list[str] | None = None) -> DataFrame:
    """Dense 1-based numbering of the whole table along a total order.

    One range shuffle, one staged write, and a prefix sum over one row per
    partition. The written table fixes which row sits in which partition, so a
    lost executor cannot renumber anything. ``keep`` names the columns that are
    written, where some are there for the order alone.
    """
    keep = keep or df.columns
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(
        placed.selectExpr(
            *[f"`{c}`" for c in keep],
            "shiftright(_place, 33) as _part", "_place & 8589934591 as _pos",
        ),
        "numbered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    # one row per partition of the staged table
    return placed.join(F.broadcast(starts), "_part").selectExpr(
        *[f"`{c}`" for c in keep], f"_start + _pos + 1 as {out}"
    )


def _hot_keys(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """(_h, _hot): hashes of the keys with more rows than a bucket, none if there is none.

    At most one number for ``BUCKET`` rows. Keys that share a hash are counted together, so a small one may be cut as well.
    """
    counts = df.groupBy(F.xxhash64(*keys).alias("_h")).count()
    hot = [(r["_h"], True) for r in counts.filter(F.col("count") > BUCKET).collect()]
    return F.broadcast(df.sparkSession.createDataFrame(hot, "_h bigint, _hot boolean")) if hot else None


def _marked(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_hot``: true or missing."""
    return df.withColumn("_key", F.xxhash64(*keys)).join(hot, F.expr("_key = _h"), "left").drop("_key", "_h")


def running_sums(
    df: DataFrame, keys: list[str], order: str, sums: dict[str, str], bucket: str | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Add inclusive running sums per key along an ``order`` that is unique within the key.

    ``facts``, at most one row per key, are columns that reach the rows with their bucket's opening sums.
    A row without a key is left out. Without a bucket of the caller's, only keys of many rows are cut into
    buckets; any other key is one bucket, which opens with nothing, so that no totals of it are needed.
    """
    columns = df.columns
    df = df.filter(" and ".join(f"`{k}` is not null" for k in keys) or "true")
    if bucket is None and keys and isinstance(df.schema[order].dataType, IntegralType):
        hot = _hot_keys(df, keys)
        if hot is not None:
            df = _marked(df, keys, hot)
            cuts = _cuts(df.filter("_hot"), order)
            df = df.withColumn("_b", F.expr(f"case when _hot is null then 0 when `{order}` is null then -1 else {_place(f'`{order}`', cuts)} end"))
            totalled = df.filter("_hot")
            if facts is not None:
                buckets = f"explode(if(_hot is null, array(0), sequence(-1, {len(cuts)}))) as _b"
                facts = _marked(facts, keys, hot).selectExpr(*[f"`{c}`" for c in facts.columns], buckets)
        else:
            df, totalled = df.withColumn("_b", F.lit(0)), None
            facts = facts.withColumn("_b", F.lit(0)) if facts is not None else None
    else:
        df = _bucketed(df, keys, order, bucket).filter("_b is not null")
        totalled = df
    place = [*keys, "_b"]
    more = [c for c in facts.columns if c not in place] if facts is not None else []
    about = facts
    if totalled is not None:
        totals = totalled.groupBy(*place).agg(*[F.expr(f"sum({e})").alias(n) for n, e in sums.items()])
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        about = totals.select(*place, *[F.sum(n).over(before).alias(f"_open_{n}") for n in sums])
        if facts is not None:
            about = about.join(facts, place, "full") if "_b" in facts.columns else about.join(facts, keys, "left")
    inside = Window.partitionBy(*place).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = df.select(*columns, "_b", *[F.sum(F.expr(e)).over(inside).alias(f"_in_{n}") for n, e in sums.items()])
    if about is not None:
        scanned = scanned.join(about, place, "left")  # the rows lie in the order of their buckets already
    # missing only where nothing was summed yet, whatever the buckets
    found = {n: F.coalesce(F.col(f"_open_{n}") + F.col(f"_in_{n}"), f"_open_{n}", f"_in_{n}") if totalled is not None else F.col(f"_in_{n}") for n in sums}
    return scanned.select(*columns, *[c.alias(n) for n, c in found.items()], *more)


def previous(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, bucket: str | None = None
) -> DataFrame:
    """Add the value of the row before, per key, across bucket borders too."""
    df = _bucketed(df, keys, order, bucket)
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    place = F.col(order)
    if isinstance(df.schema[order].dataType, IntegralType):  # a row without a place comes first, maybe alone in its bucket
        place = F.coalesce(place.cast("bigint"), F.lit(-(1 << 63)))
    tails = (
        df.groupBy(*keys, "_b").agg(F.max_by(F.col(value), place).alias("_last"))
        .select(*keys, "_b", F.lag("_last").over(by_bucket).alias("_tail"))
    )
    inside = Window.partitionBy(*keys, "_b").orderBy(order)
    return (
        df.join(tails, [*keys, "_b"])
        .select(
            *df.columns,
            F.when(F.row_number().over(inside) == 1, F.col("_tail"))
            .otherwise(F.lag(value).over(inside)).alias(out),
        )
        .drop("_b")
    )


def running_max(df: DataFrame, order: str, value: str, out: str, bucket: str | None = None) -> DataFrame:
    """Add the largest value up to each row along a unique ``order`` of the whole table."""
    df = _bucketed(df, [], order, bucket)
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket
    tops = df.groupBy("_b").agg(F.max(value).alias("_top")).select("_b", F.max("_top").over(before).alias("_before"))
    inside = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.join(tops, "_b").select(*df.columns, F.greatest("_before", F.max(value).over(inside)).alias(out)).drop("_b")
