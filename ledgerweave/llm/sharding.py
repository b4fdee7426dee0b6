"""Shards of near-equal bytes by k-d tree partitioning over document metadata.

A node of the tree is split along its widest metadata dimension (the range of
its values over the range of all) at the weighted median: the row at which the
bytes to the left reach the left children's share. The median is found by radix
selection: a histogram of bytes over 13 bits at a time of (coordinate, hash of
the row's columns, row number), so that any number of equal coordinates or of
equal rows is split at the exact row. Histograms have at most 8192 bins a node;
nodes of one level are split together. Splitting goes on until leaves reach the
target bytes. Sizes of two leaves differ by a few rows at most.

Whole numbers, negative ones too, are their own coordinates; columns of any other
type are ordered by the rank of their whole value among the different values.
Nulls count as the least value. Bytes decide, not groups: equal texts are kept
together only where their metadata is. Columns of the input named like a result
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import without
from ledgerweave.operators.scan import number_rows
from ledgerweave.session import stage

DIGIT, WIDTH = 13, 52
_PASSES = WIDTH // DIGIT
_WHOLE = ("tinyint", "smallint", "int", "bigint")
#: Rows of one numbering group at which a shard's slots are dealt out, on average.
SLOT_GROUP = 20_000
SLOT_GROUPS = 64


def coordinates(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """``rows`` with c0, c1, ... for the dimensions: whole numbers from 0 below 2^52 that keep their order."""
    kinds, given = dict(rows.dtypes), len(rows.columns)
    whole = [d for d in dimensions if kinds[d] in _WHOLE]
    limits = rows.select(*[f(F.col(f"`{d}`").cast("long")) for d in whole for f in (F.min, F.max)]).first() if whole else ()
    least = {d: limits[2 * i:2 * i + 2] for i, d in enumerate(whole)}
    for i, d in enumerate(dimensions):
        value = F.col(f"`{d}`")
        if d in least:
            low, high = (x or 0 for x in least[d])
            # a range beyond 52 bits loses its lowest ones; rows they told apart are split by their hash
            beyond = (high - low).bit_length() - WIDTH
            shift = beyond + 1 if beyond > 0 else 0
            rows = rows.withColumn(f"c{i}", F.coalesce(F.shiftright(value.cast("long"), shift) - F.lit(low >> shift), F.lit(0)))
        else:
            ranks = number_rows(rows.select(value.alias(f"v{i}")).where(value.isNotNull()).distinct(), [f"v{i}"], f"c{i}")
            rows = rows.join(ranks, value == F.col(f"v{i}"), "left").drop(f"v{i}").withColumn(f"c{i}", F.coalesce(F.col(f"c{i}").cast("long"), F.lit(0)))
    return rows.select(*rows.columns[:given], *[f"c{i}" for i in range(len(dimensions))])


def _digit(step: int) -> Column:
    """The digit of pass ``step``: first the coordinate's, then the hash's, then the row number's."""
    key = F.col(f"k{step // _PASSES}")
    return F.shiftright(key, WIDTH - DIGIT * (step % _PASSES + 1)).bitwiseAND((1 << DIGIT) - 1).cast("int")


def _cuts(rows: DataFrame, nodes: dict[int, dict]) -> None:
    """Sets in each node the key (up to three numbers) before which rows go left."""
    spark = rows.sparkSession
    todo = dict(nodes)
    for n in nodes.values():
        n |= {"digits": [], "below": 0}
    for step in range(3 * _PASSES):
        # rows whose digits so far are those of their node's median
        state = spark.createDataFrame([(i, *[int("0" if not n["digits"][k * _PASSES:] else "".join(f"{d:013b}" for d in n["digits"][k * _PASSES:(k + 1) * _PASSES]) or "0", 2) for k in range(3)]) for i, n in todo.items()], "node int, p0 long, p1 long, p2 long")
        match = F.lit(True)
        for k in range(3):
            known = min(max(step - k * _PASSES, 0), _PASSES)
            if known:
                match &= F.shiftright(f"k{k}", WIDTH - DIGIT * known) == F.col(f"p{k}")
        inside = rows.join(F.broadcast(state), "node").where(match)
        bins: dict[int, list] = {i: [] for i in todo}
        for node, digit, size, count in inside.groupBy("node", _digit(step).alias("digit")).agg(F.sum("size"), F.count("*")).collect():
            bins[node].append((digit, size, count))
        for i, found in bins.items():
            n = nodes[i]
            for digit, size, count in sorted(found):
                if n["below"] + size >= n["cut"] or digit == max(found)[0]:
                    n["digits"].append(digit)
                    if count == 1:
                        n["with_median"] = n["below"] + size / 2 <= n["cut"]
                        todo.pop(i)
                    break
                n["below"] += size
        if not todo:
            return
    for i in todo:  # rows that are equal in all 156 bits stay together
        nodes[i]["with_median"] = False


def _split(rows: DataFrame, nodes: dict[int, dict], dimensions: list[str]) -> DataFrame:
    """``rows`` with the children of the split nodes in place of them."""
    spark = rows.sparkSession
    chosen = spark.createDataFrame([(i, n["dimension"]) for i, n in nodes.items()], "node int, dimension int")
    keyed = rows.join(F.broadcast(chosen), "node").withColumn("k0", F.element_at(F.array(*[F.col(f"c{d}") for d in range(len(dimensions))]), F.col("dimension") + 1))
    _cuts(keyed, nodes)
    bound = []
    for i, n in nodes.items():
        padded = n["digits"] + [0] * (3 * _PASSES - len(n["digits"]))
        known = DIGIT * len(n["digits"])
        prefix = [int("".join(f"{d:013b}" for d in padded[k * _PASSES:(k + 1) * _PASSES]), 2) for k in range(3)]
        bound.append((i, *prefix, *[WIDTH - min(max(known - k * WIDTH, 0), WIDTH) for k in range(3)], n["with_median"], n["left"], n["right"]))
    bounds = spark.createDataFrame(bound, "node int, b0 long, b1 long, b2 long, s0 int, s1 int, s2 int, with_median boolean, left int, right int")
    mine = F.struct(*[F.expr(f"shiftleft(shiftright(k{k}, s{k}), s{k})").alias(f"k{k}") for k in range(3)])
    cut = F.struct(*[F.col(f"b{k}").alias(f"k{k}") for k in range(3)])
    child = F.when((mine < cut) | (F.col("with_median") & (mine == cut)), F.col("left")).otherwise(F.col("right"))
    moved = keyed.join(F.broadcast(bounds), "node").withColumn("node", child).select(*rows.columns)
    still = rows.join(F.broadcast(chosen), "node", "left_anti")
    return stage(still.select(*rows.columns).union(moved), "kd-rows")


def shard(docs: DataFrame, dimensions: list[str], size: str = "size", shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``docs`` with shard (from 0) and slot (gapless from 0 in each shard).

    ``size``: a column of positive whole numbers. Either the number of shards or
    the bytes of each is given. An empty table stays empty.
    """
    docs = without(docs, "shard", "slot")
    spark = docs.sparkSession
    kept = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row")), "kd-docs")
    field = lambda c: F.col(f"doc.`{c}`")
    # row numbers are dense in their low bits within a partition: 33 bits and the partition's 19
    keys = kept.select(
        F.lit(1).alias("node"), field(size).cast("long").alias("size"),
        F.pmod(F.xxhash64(F.lit(0), *[field(c) for c in docs.columns if c != size]), F.lit(1 << WIDTH)).alias("k1"),
        F.col("row").alias("k2"), "row", *[field(d).alias(f"d{i}") for i, d in enumerate(dimensions)])
    placed_at = coordinates(keys, [f"d{i}" for i in range(len(dimensions))])
    rows = stage(placed_at.drop(*[f"d{i}" for i in range(len(dimensions))]), "kd-rows")
    span = [f(f"c{d}").alias(f"{f.__name__}{d}") for d in range(len(dimensions)) for f in (F.min, F.max)]
    measured = lambda: {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("total"), F.count("*").alias("n"), *span).collect()}
    found = measured()
    leaves = {1: 1}
    if found:
        whole = found[1]
        leaves = {1: shards or max(1, -(-whole["total"] // target_bytes))}
        while any(q > 1 for q in leaves.values()):
            nodes = {}
            for i, quota in [(i, q) for i, q in leaves.items() if q > 1]:
                left, right = 2 * i, 2 * i + 1
                leaves |= {left: quota // 2, right: quota - quota // 2}
                del leaves[i]
                if i in found:
                    r = found[i]
                    width = [(r[f"max{d}"] - r[f"min{d}"]) / max(1, whole[f"max{d}"] - whole[f"min{d}"]) for d in range(len(dimensions))]
                    nodes[i] = {"left": left, "right": right, "dimension": max(range(len(width)), key=lambda d: width[d]), "cut": r["total"] * (quota // 2) / quota}
            if nodes:
                rows = _split(rows, nodes, dimensions)
                found = measured()
    # in the order of the tree, from left to right
    depth = max(i.bit_length() for i in leaves)
    order = sorted(leaves, key=lambda i: i << (depth - i.bit_length()))
    numbers = spark.createDataFrame([(i, s) for s, i in enumerate(order)], "node int, shard int")
    total = sum(r["n"] for r in found.values())
    groups = max(SLOT_GROUPS, total // SLOT_GROUP)
    placed = rows.join(F.broadcast(numbers), "node").select("row", "shard", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("part"))
    return _slots(placed, kept, docs.columns)


def _slots(placed: DataFrame, kept: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers rows in each part of a shard, then shifts each part by the rows before it."""
    from pyspark.sql import Window

    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    numbered = placed.withColumn("at", F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1)
    slots = numbered.join(before, ["shard", "part"]).select("row", "shard", (F.col("before") + F.col("at")).cast("long").alias("slot"))
    return kept.join(slots, "row").select(*[F.col(f"doc.`{c}`") for c in columns], "shard", "slot")
