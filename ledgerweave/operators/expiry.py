"""Timers of pending transfers as events of the posting order.

A clock runs along the order: the largest time seen so far. A pending transfer
with a timeout is released before the first event at which the clock has reached
its time; the release is a void that no command sent, under an id no command can
carry. Posting treats it as any other void: the reserve returns there, room under
a limit included, and a post that comes later is too late. Where the order is cut
into batches does not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.functions import values as v
from ledgerweave.operators import posting
from ledgerweave.operators.scan import number_rows, running_max

#: What a release needs of its pending transfer.
WAITING = ["id", "amount", "ledger_id", "code", "expires_at"]


def with_clock(events: DataFrame, time: str, start: int | None = None, bucket: str | None = None) -> DataFrame:
    """Add ``clock``: the largest ``time`` (SQL text, a number) up to each event, ``start`` at least."""
    timed = events.withColumn("_time", F.expr(time) if start is None else F.expr(f"greatest({time}, {start}L)"))
    return running_max(timed, "seq", "_time", "clock", bucket).drop("_time")


def timers(events: DataFrame, ticks_per_second: int) -> DataFrame:
    """(id, ..., expires_at) of the pending transfers of ``events`` that have a timeout; of a repeated id the first counts."""
    first = events.groupBy("id").agg(F.min_by(F.struct("flags", "timeout_s", "clock", "amount", "ledger_id", "code"), "seq").alias("e")).select("id", "e.*")
    return first.filter(f"(flags & {v.PENDING}) <> 0 and timeout_s > 0").selectExpr(
        "id", "amount", "ledger_id", "code", f"clock + timeout_s * {ticks_per_second} as expires_at")


def merge(events: DataFrame, waiting: DataFrame, now: int, start: int = 0) -> DataFrame:
    """``events`` (with seq and clock) and the releases due up to ``now``, numbered anew from ``start`` + 1 on in one order.

    ``waiting`` has the timers of earlier and of these events. A release whose
    pending transfer was resolved or refused fails when posted, and is then dropped.
    """
    releases = waiting.filter(F.col("expires_at") <= now).selectExpr(
        f"concat('{posting.EXPIRY_PREFIX}', id) as id", "id as pending_id", "amount", "ledger_id", "code", f"{v.VOID} as flags",
        "0L as timeout_s", "expires_at as clock", "0 as _kind")
    both = events.withColumn("_kind", F.lit(1)).unionByName(releases, allowMissingColumns=True)
    order = number_rows(both, ["clock", "_kind", "seq", "id"], "_place")
    return order.withColumn("seq", F.expr(f"{start}L + _place")).drop("_place", "_kind")


def applied(posted: DataFrame) -> DataFrame:
    """Posted rows without the releases that had nothing to release."""
    return posted.filter(f"error is null or not {posting.EXPIRY}")
