"""Runs, bounded batches and chains over a command stream."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerweave.operators.scan import dense, previous, running_sums
from ledgerweave.session import stage

# workers get these functions by value and need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORD = ["topic", "partition", "offset"]


def op_runs(commands: DataFrame) -> DataFrame:
    """Number the runs of consecutive commands of one kind per topic partition."""
    marked = previous(commands, ["topic", "partition"], "offset", "op", "_before", dense("offset"))
    return running_sums(
        marked, ["topic", "partition"], "offset", {"run": "if(_before is null or _before <> op, 1, 0)"}, dense("offset")
    ).drop("_before")


#: Offsets of one block of a partition, and blocks of one run; the result does not depend on them.
BLOCK, FAN = 1 << 17, 64


def _walk(op, n, limit: int):
    """For each command: where the batch that starts with it ends (exclusive)."""
    total = np.concatenate([[0], np.cumsum(n)])
    change = np.flatnonzero(op[1:] != op[:-1]) + 1
    runs = np.searchsorted(change, np.arange(len(op)), side="right")
    run_end = np.concatenate([change, [len(op)]])[runs]
    return total, run_end, np.minimum(np.searchsorted(total, total[:-1] + limit, side="right") - 1, run_end)


def _first_end(total, run_end, limit: int, filled):
    """Where a batch ends that enters the block with ``filled`` events of the first command's kind."""
    return np.minimum(np.searchsorted(total, limit - filled, side="right") - 1, run_end[0])


def _outlook(limit: int):
    """What a block makes of every possible entry: batches begun in it, and how full the last one is left."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        op, n = pdf["op"].to_numpy(), pdf["n_events"].to_numpy()
        total, run_end, end = _walk(op, n, limit)
        size = len(op)
        begun, left = np.ones(size + 1, np.int64), np.zeros(size + 1, np.int64)
        begun[size] = 0
        for i in range(size - 1, -1, -1):
            if end[i] < size:
                begun[i], left[i] = 1 + begun[end[i]], left[end[i]]
            else:
                left[i] = (total[size] - total[i]) % limit
        filled = np.arange(limit)
        at = _first_end(total, run_end, limit, filled)
        through = at == size
        enters = np.where(through, 0, begun[at])
        leaves = np.where(through, (filled + total[size]) % limit, left[at])
        enters[0], leaves[0] = begun[0], left[0]
        return pd.DataFrame({
            "topic": pdf["topic"].iloc[:1], "partition": pdf["partition"].iloc[:1], "block": pdf["block"].iloc[:1],
            "first": op[:1], "last": op[-1:], "begun": [enters], "left": [leaves]})

    return run


def _composed(limit: int):
    """The outlook of a run of blocks: their outlooks applied one after another, for every possible entry at once."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        filled, begun, kind = np.arange(limit), np.zeros(limit, np.int64), None
        for first, last, b, left in zip(pdf["first"], pdf["last"], pdf["begun"], pdf["left"], strict=True):
            if kind is not None and first != kind:
                filled = np.zeros(limit, np.int64)
            begun, filled, kind = begun + np.asarray(b)[filled], np.asarray(left)[filled], last
        return pd.DataFrame({
            "topic": pdf["topic"].iloc[:1], "partition": pdf["partition"].iloc[:1], "block": pdf["run"].iloc[:1],
            "first": pdf["first"].iloc[:1], "last": [kind], "begun": [begun], "left": [filled]})

    return run


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """Follow the blocks of a run in order: how each is entered, given how the run is."""
    pdf = pdf.sort_values("block")
    filled, batches, kind, out = int(pdf["enter_filled"].iloc[0]), int(pdf["enter_before"].iloc[0]), None, []
    for first, last, begun, left in zip(pdf["first"], pdf["last"], pdf["begun"], pdf["left"], strict=True):
        filled = filled if kind is None or first == kind else 0
        out.append((filled, batches))
        batches, filled, kind = batches + int(begun[filled]), int(left[filled]), last
    return pdf[["topic", "partition", "block"]].assign(filled=[f for f, _ in out], before=[b for _, b in out])


_BLOCK = "topic string, partition int, block bigint"
_OUTLOOK = f"{_BLOCK}, first string, last string, begun array<bigint>, left array<bigint>"


def _entered(outlook: DataFrame, limit: int, fan: int) -> DataFrame:
    """How every block is entered.

    Outlooks are functions of the entry, and functions compose: runs of ``fan``
    blocks become one outlook each, runs of runs again, until a partition has few
    left; then the entries come down the same way. No task sees more than ``fan``
    outlooks, however long a partition is.
    """
    outlook = stage(outlook, "outlooks")
    most = outlook.groupBy("topic", "partition").count().agg(F.max("count")).first()[0] or 0
    place = ["topic", "partition"]
    if most <= fan:
        return outlook.withColumn("enter_filled", F.lit(0)).withColumn("enter_before", F.lit(0)).groupBy(*place).applyInPandas(
            _entries, f"{_BLOCK}, filled bigint, before bigint")
    runs = outlook.withColumn("run", F.expr(f"block div {fan}"))
    above = _entered(runs.groupBy(*place, "run").applyInPandas(_composed(limit), _OUTLOOK), limit, fan)
    above = above.selectExpr(*place, "block as run", "filled as enter_filled", "before as enter_before")
    return runs.join(above, [*place, "run"]).groupBy(*place, "run").applyInPandas(_entries, f"{_BLOCK}, filled bigint, before bigint")


def _placed(limit: int):
    """Number the batches of a block whose entry is known."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        total, run_end, end = _walk(pdf["op"].to_numpy(), pdf["n_events"].to_numpy(), limit)
        filled, batch, at = int(pdf["filled"].iloc[0]), int(pdf["before"].iloc[0]) - 1, 0
        out = np.empty(len(pdf), np.int64)
        if filled:
            at = int(_first_end(total, run_end, limit, filled))
            out[:at] = batch
        while at < len(out):
            batch += 1
            out[at:end[at]] = batch
            at = int(end[at])
        return pdf[["topic", "partition", "offset", "op", "n_events"]].assign(batch=out)

    return run


def command_batches(commands: DataFrame, limit: int, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Greedy packing of whole commands, never across a run, at most ``limit`` events.

    Exact for partitions of any length: each block of offsets works out what it
    would do for every fill level it may be entered with, composing these picks
    the level that comes true, and the blocks then number their batches. A block,
    or the outlooks of ``fan`` blocks (2 * ``limit`` numbers each), is one task's
    group. Commands that can never be sent keep their reason in ``error``.
    """
    sized = commands.select("topic", "partition", "offset", "op", "n_events").withColumn("error", F.expr(
        f"case when n_events = 0 then 'empty_command' when n_events > {limit} then 'command_too_large' end"))
    rows = sized.filter("error is null").withColumn("block", F.expr(f"offset div {block}")).drop("error")
    place = ["topic", "partition", "block"]
    entered = _entered(rows.groupBy(*place).applyInPandas(_outlook(limit), _OUTLOOK), limit, fan)
    packed = rows.join(entered, place).groupBy(*place).applyInPandas(
        _placed(limit), "topic string, partition int, offset bigint, op string, n_events int, batch bigint")
    return packed.unionByName(sized.filter("error is not null"), allowMissingColumns=True)


def chains(events: DataFrame) -> DataFrame:
    """Add ``chain_id``: a run of ``linked`` events and the one that closes it.

    A chain never leaves its command, and a command's size is limited, so the
    window is bounded. Events outside any chain have a NULL ``chain_id``.
    """
    # a chain begins with a linked event: records that hold none need no window
    linked = events.filter("(flags & 1) <> 0").select(*RECORD).distinct()
    alone = events.join(linked, RECORD, "left_anti").select(*events.columns, F.lit(None).cast("bigint").alias("chain_id"))
    events = events.join(linked, RECORD, "left_semi").select(*events.columns)
    record = Window.partitionBy(*RECORD).orderBy("idx")
    opened = F.coalesce(F.lag(F.expr("flags & 1")).over(record), F.lit(0)) == 0
    numbered = events.withColumn("_c", F.sum(F.when(opened, 1).otherwise(0)).over(record))
    chain = Window.partitionBy(*RECORD, "_c")
    return numbered.select(
        *events.columns,
        F.when(F.count("*").over(chain) > 1, F.min("seq").over(chain)).alias("chain_id"),
    ).unionByName(alone)


def align_outcomes(commands: DataFrame, replies: DataFrame) -> DataFrame:
    """Give every event of a batch its positional reply.

    ``commands``: batch_id, batch_size, start, id, idx. ``replies``: batch_id, pos,
    raw. A reply of the wrong length, or a window outside the batch, fails the
    whole batch: outcomes must never land on the wrong command.
    """
    counts = replies.groupBy("batch_id").agg(F.count("*").alias("_replies"))
    rows = commands.join(counts, "batch_id", "left").withColumn("pos", F.expr(
        "if(coalesce(_replies, 0) <> batch_size or start < 0 or start + idx >= batch_size,"
        " raise_error(concat('result count does not match batch size in batch ', batch_id)), start + idx)"))
    return rows.join(replies, ["batch_id", "pos"]).drop("_replies")
