"""Offset progress from a log of marks: what may be committed, what must be re-read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators.scan import dense, running_sums

PART = ["topic", "partition"]


def progress_state(marks: DataFrame) -> DataFrame:
    """Fold ``track`` / ``done`` / ``commit`` marks into one row per offset.

    The order of marks does not matter; a ``done`` counts only for a tracked
    offset, and entries below the committed watermark are dropped.
    """
    committed = marks.filter("mark = 'commit'").groupBy(*PART).agg(F.max("offset").alias("committed"))
    folded = (
        marks.filter("mark <> 'commit'").groupBy(*PART, "offset")
        .agg(
            F.expr("bool_or(mark = 'track')").alias("tracked"), F.expr("bool_or(mark = 'done')").alias("done"),
            F.max("leader_epoch").alias("leader_epoch"),
        )
        .filter("tracked")
    )
    return (
        folded.join(committed, PART, "left")
        .filter("not (done and offset < coalesce(committed, -1))")
        .selectExpr(*PART, "offset", "leader_epoch", "done", "coalesce(committed, -1) as committed")
    )


def _edges(state: DataFrame) -> DataFrame:
    return state.groupBy(*PART).agg(
        F.expr("min(offset) filter (where not done)").alias("first_pending"),
        F.expr("max(offset) filter (where done)").alias("last_done"),
        F.max("committed").alias("committed"), F.min("offset").alias("lowest"), F.max("offset").alias("highest"),
    )


def committable(state: DataFrame) -> DataFrame:
    """Per partition the next offset to commit, with the epoch of the record before it."""
    marks = _edges(state).selectExpr(
        *PART, "committed", "coalesce(first_pending, last_done + 1) as watermark"
    ).filter("watermark > committed").selectExpr(*PART, "watermark", "watermark - 1 as offset")
    boundary = state.filter("done").select(*PART, "offset", "leader_epoch")
    return marks.join(boundary, [*PART, "offset"]).select(*PART, "watermark", "leader_epoch")


def rewind_points(state: DataFrame) -> DataFrame:
    """Per partition with unfinished records, where to read again."""
    points = _edges(state).filter("first_pending is not null").selectExpr(
        *PART, "first_pending as rewind_to", "first_pending - 1 as offset")
    boundary = state.filter("done").select(*PART, "offset", "leader_epoch")
    return points.join(boundary, [*PART, "offset"], "left").selectExpr(
        *PART, "rewind_to", "coalesce(leader_epoch, -1) as leader_epoch")


def commit_lag(state: DataFrame) -> DataFrame:
    return _edges(state).selectExpr(
        *PART, "highest + 1 - if(committed < 0, lowest, committed) as lag")


def in_flight(state: DataFrame) -> DataFrame:
    return state.agg(F.expr("count_if(not done)").alias("in_flight"))


def leading_prefix(records: DataFrame, good: str) -> DataFrame:
    """Records before the first one of their partition that is not ``good``.

    The first bad offset is an aggregate, so no partition is ever scanned in order.
    """
    stops = records.filter(f"not ({good})").groupBy(*PART).agg(F.min("offset").alias("_stop"))
    return (
        records.join(stops, PART, "left").filter("_stop is null or offset < _stop").select(*records.columns)
    )


def acked_prefix(records: DataFrame) -> DataFrame:
    """The contiguous prefix of acknowledged records: exactly what counts as done."""
    return leading_prefix(records, "acked")


def failure_cut(records: DataFrame) -> DataFrame:
    """Records ahead of the first failed one of their partition; the rest must wait for its retry."""
    return leading_prefix(records, "not failed")


def pass_cap(records: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` records per partition and pass, in offset order.

    The rank comes from a two-level running count, so one busy partition is
    still counted by many tasks.
    """
    ranked = running_sums(records, PART, "offset", {"_rank": "1"}, dense("offset"))
    return ranked.filter(f"_rank <= {limit}").drop("_rank")


def partition_order(events: DataFrame, *order: str) -> DataFrame:
    """Rows in topic, partition and offset order, a busy partition split along its offsets."""
    return events.repartitionByRange(*PART, *order).sortWithinPartitions(*PART, *order)
