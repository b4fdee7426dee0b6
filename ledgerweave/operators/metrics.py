"""Counters and histograms as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# fixed values: histogram bounds
BATCH_BOUNDS = [1, 10, 100, 500, 1000, 2000, 4000, 8189]
LATENCY_BOUNDS = [0.001 * 2**i for i in range(14)]


def record_results(decoded: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per finished record: ``poison``, ``rejected`` (any event is) or ``ok``."""
    applied = outcomes.groupBy("topic", "partition", "offset").agg(
        F.expr("if(bool_or(status = 'rejected'), 'rejected', 'ok')").alias("result")
    )
    poison = decoded.filter("error is not null").selectExpr(
        "topic", "partition", "offset", "'poison' as result")
    return applied.unionByName(poison)


def records_total(decoded: DataFrame, outcomes: DataFrame) -> DataFrame:
    return record_results(decoded, outcomes).groupBy("result").agg(F.count("*").alias("n"))


def events_total(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))


def dlq_total(decoded: DataFrame, outcomes: DataFrame) -> DataFrame:
    letters = decoded.filter("error is not null").selectExpr("'poison' as reason", "error").unionByName(
        outcomes.filter("status = 'rejected'").selectExpr("'reject' as reason", "error"))
    return letters.groupBy("reason", "error").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, bounds: list, by: list[str] | None = None) -> DataFrame:
    """Cumulative bucket counts (``le``), one aggregate per bound in a single pass."""
    counts = df.groupBy(*(by or [])).agg(
        *[F.expr(f"count_if({value} <= {b!r})").alias(f"_{i}") for i, b in enumerate(bounds)],
        F.count("*").alias("_all"),
    )
    pairs = ", ".join(f"named_struct('le', '{b!r}', 'n', _{i})" for i, b in enumerate(bounds))
    return counts.selectExpr(*(by or []), f"inline(array({pairs}, named_struct('le', '+Inf', 'n', _all)))")


#: Cuts that spread the values of one key over buckets; they only balance the work, the result is exact.
CUTS = 100


def statistics(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Count, total and exact quantiles (linear between ranks) of ``value`` for each key.

    Ranks are found in two levels: a partial count of every value, a prefix sum
    over the buckets of a key, and one over the values inside each bucket. No
    task holds all values of a key. Nulls are left out of the quantiles.
    """
    quantiles = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    totals = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.expr(f"sum({value})").alias("total"), F.count(F.expr(value)).alias("_n"),
        F.expr(f"percentile_approx({value}, array({', '.join(f'{i / CUTS}D' for i in range(1, CUTS))}), 1000)").alias("_cuts"))
    keys = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    named = totals.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_n", "_cuts")
    counts = df.filter(f"{value} is not null").groupBy(*by, F.expr(value).alias("_v")).agg(F.count("*").alias("_c"))
    counts = counts.join(named, keys).select(
        *by, "_v", "_c", "_n", F.expr("size(filter(_cuts, c -> c < _v))").alias("_b"))
    buckets = counts.groupBy(*by, "_b").agg(F.sum("_c").alias("_all"))
    start = buckets.select(
        *[F.col(c).alias(f"_k_{c}") for c in by], F.col("_b").alias("_at"),
        (F.sum("_all").over(Window.partitionBy(*by).orderBy("_b")) - F.col("_all")).alias("_start"))
    inside = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_in", F.sum("_c").over(inside)).join(start, [*keys, F.col("_b") == F.col("_at")]).withColumn(
        "_upto", F.col("_start") + F.col("_in"))
    ends = ranked.groupBy(*by).agg(*[
        F.expr(f"min(if(_upto > {side}({q}D * (_n - 1)), _v, null))").alias(f"_{name}_{side}")
        for name, q in quantiles for side in ("floor", "ceil")])
    ends = ends.select(*[F.col(c).alias(f"_k_{c}") for c in by], *[c for c in ends.columns if c not in by])
    spot = {name: f"({q}D * (_n - 1))" for name, q in quantiles}
    return totals.join(ends, keys, "left").selectExpr(*by, "n", "total", *[
        f"cast(if(floor({r}) = ceil({r}), _{name}_floor, (ceil({r}) - {r}) * _{name}_floor + ({r} - floor({r})) * _{name}_ceil) as double) as {name}"
        for name, r in spot.items()])
