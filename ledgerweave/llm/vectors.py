"""What the two vector operators share: which vectors take part, equal ones as one, a sample, blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import ship
from ledgerweave.session import stage

ship(__name__)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null, NaN or infinite component, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def numbered(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Written (row, id, vector, usable)."""
    v = F.col(f"`{vector}`")
    return stage(table.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("id"), v.cast("array<double>").alias("vector"), usable(v.cast("array<double>")).alias("usable")), "vectors")


def lengths(nodes: DataFrame) -> list[tuple[int, int]]:
    """Lengths of the vectors and how many there are of each. Vectors of one length are compared, each length by
    an index of its own; a table has few lengths, most often one."""
    return sorted((r["length"], r["count"]) for r in nodes.groupBy(F.size("vector").alias("length")).count().collect())


def sampled(nodes: DataFrame, most: int) -> np.ndarray:
    """Unit vectors of at most ``most`` nodes, chosen by a hash: the bounded sample an index is fitted on."""
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(most).select("vector").toArrow()["vector"].to_pylist()
    x = np.array(drawn, float) if drawn else np.zeros((0, 2))
    return x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x


def unit(column) -> np.ndarray:
    """Unit vectors from a pandas column of arrays; scaled first, so that no square over- or underflows."""
    x = np.stack([np.asarray(v, float) for v in column])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def blocked(members: DataFrame, visitors: DataFrame, cell: list[str], member_block: int, visitor_block: int, columns: list[str]) -> DataFrame:
    """Rows of the units (cell, i, j): a block of a cell's members and a block of its visitors.

    Both tables have ``cell`` and ``columns``, ``node`` among these. A cell of any
    size becomes many units of bounded size. The number of cells is bounded by the
    sample an index is fitted on, so the counts are small.
    """
    counts = members.groupBy(*cell).agg(F.ceil(F.count("*") / member_block).cast("int").alias("mb")).join(
        visitors.groupBy(*cell).agg(F.ceil(F.count("*") / visitor_block).cast("int").alias("vb")), cell)
    counts = F.broadcast(stage(counts, "cells"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = members.join(counts, cell).select(*cell, *columns, F.lit(True).alias("member"), own("mb").alias("i"), "vb").select(*cell, *columns, "member", "i", every("vb").alias("j"))
    right = visitors.join(counts, cell).select(*cell, *columns, F.lit(False).alias("member"), own("vb").alias("j"), "mb").select(*cell, *columns, "member", every("mb").alias("i"), "j")
    return left.unionByName(right)
