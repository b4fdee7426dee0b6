"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits a bounded sample by random directions at the median until
leaves are small; every vector of the table is put into one leaf of each tree. A
query descends all trees with one shared priority queue: the open branch whose
walls are nearest to the query is opened next, whatever its tree. After as many
leaves as the sample needed for the target recall it stops. The leaves' vectors
are scored exactly by cosine in double precision and the nearest are kept.

Equal vectors are one candidate that stands for its smallest ids; k + 1 of them
are enough. A leaf of any size is worked off in blocks, each of which returns
the k + 1 nearest for each of its queries, as far as they are not behind the
k + 1 nearest that the query found in the leaves it opened first.

Trees grow with the table, so that a leaf holds PER_LEAF vectors on average, until
the sample is used up. Vectors of different lengths have no cosine; each length
has a forest of its own, one after another.

Vectors that are null, zero or hold null or non-finite components take no part,
neither do null ids. Rows are told apart by their place, not by their id: rows
that repeat an id each have a ranking, in which the others are candidates.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerweave.llm import vectors
from ledgerweave.llm.common import Shared, ship
from ledgerweave.llm.vectors import unit as unit_vectors
from ledgerweave.session import stage

ship(__name__)

TREES, RECALL = 4, 0.95
#: Vectors the trees are fitted on, at most, and those of them that measure the recall.
SAMPLE, TRIED = 20_000, 400
#: Least leaves of a tree, sample vectors in each at least, and vectors of the table in a leaf on average.
LEAVES, LEAF, PER_LEAF = 64, 8, 200
MEMBERS, VISITORS = 4096, 1024
#: Leaves a query opens first. What it finds there bounds what the others return, so that rows do not grow with the leaves opened.
FIRST = 2 * TREES


@dataclass
class Tree:
    """Inner nodes have a direction, a threshold and two children; leaves have a number from 0."""

    direction: list[np.ndarray] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    children: list[tuple[int, int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def grow(self, x: np.ndarray, draw: np.random.Generator, most: int) -> int:
        at = len(self.leaf)
        self.direction.append(np.zeros(0))
        self.threshold.append(0.0)
        self.children.append((-1, -1))
        self.leaf.append(-1)
        if len(x) > most:
            direction = draw.standard_normal(x.shape[1])
            direction /= np.linalg.norm(direction)
            height = x @ direction
            middle = float(np.median(height))
            low = height <= middle
            if low.any() and not low.all():
                self.direction[at], self.threshold[at] = direction, middle
                self.children[at] = (self.grow(x[low], draw, most), self.grow(x[~low], draw, most))
                return at
        self.leaf[at] = self.leaves
        self.leaves += 1
        return at

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), np.int64)
        work = [(0, np.arange(len(x)))]
        while work:
            at, which = work.pop()
            if self.leaf[at] >= 0:
                out[which] = self.leaf[at]
                continue
            low = x[which] @ self.direction[at] <= self.threshold[at]
            work += [(self.children[at][0], which[low]), (self.children[at][1], which[~low])]
        return out


@dataclass
class Forest:
    trees: list[Tree]
    visits: int = 1

    def order(self, q: np.ndarray, most: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue: nearest walls first."""
        queue, found = [(0.0, t, 0) for t in range(len(self.trees))], []
        while queue and len(found) < most:
            far, t, at = heapq.heappop(queue)
            tree = self.trees[t]
            while tree.leaf[at] < 0:
                gap = float(q @ tree.direction[at]) - tree.threshold[at]
                low, high = tree.children[at]
                at, other = (low, high) if gap <= 0 else (high, low)
                heapq.heappush(queue, (max(far, abs(gap)), t, other))
            found.append((t, tree.leaf[at]))
        return found


def leaves_for(vectors_in_all: int) -> int:
    """Leaves of a tree for a table of that many different vectors."""
    return max(LEAVES, min(vectors_in_all // PER_LEAF, SAMPLE // LEAF))


def fit(x: np.ndarray, k: int, recall: float = RECALL, trees: int = TREES, leaves: int = LEAVES) -> Forest:
    """Trees over the sample, and the leaves a query must visit for the target recall of its k nearest."""
    draw = np.random.Generator(np.random.PCG64(13))
    forest = Forest([Tree() for _ in range(trees)])
    for tree in forest.trees:
        tree.grow(x, draw, max(LEAF, len(x) // leaves))
    places = np.stack([t.place(x) for t in forest.trees])
    total = sum(t.leaves for t in forest.trees)
    ranks = []
    for i in draw.permutation(len(x))[:TRIED]:
        score = x @ x[i]
        score[i] = -2
        nearest = np.argsort(-score, kind="stable")[: min(k, len(x) - 1)]
        rank = {leaf: r for r, leaf in enumerate(forest.order(x[i], total), 1)}
        ranks += [min(rank[t, int(places[t, j])] for t in range(trees)) for j in nearest]
    forest.visits = int(np.quantile(ranks, recall, method="higher")) if ranks else total
    return forest


def _scored(k: int):
    def run(unit):
        import pandas as pd

        member = unit["member"].to_numpy()
        node, x = unit["node"].to_numpy(), unit_vectors(unit["vector"])
        first, least = unit["first"].to_numpy(), unit["least"].to_numpy()
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        if not len(m) or not len(q):
            return pd.DataFrame({"query": [], "node": [], "first": [], "score": []}).astype({"query": "int64", "node": "int64", "first": "int64"})
        rough = x[q] @ x[m].T
        most = min(k + 1, len(m))
        # all that may be among the nearest, ties at the border included
        border = -np.partition(-rough, most - 1, axis=1)[:, most - 1: most]
        i, j = np.nonzero(rough >= np.maximum(border, least[q][:, None]) - 1e-12)
        score = (x[q[i]] * x[m[j]]).sum(1)
        by = np.lexsort((first[m[j]], -score, i))
        i, j, score = i[by], j[by], score[by]
        at = np.arange(len(i)) - np.searchsorted(i, i)
        keep = at < most
        near = m[j[keep]]
        return pd.DataFrame({"query": node[q[i[keep]]], "node": node[near], "first": first[near], "score": score[keep]})

    return run


def nearest(table: DataFrame, queries, k: int = 5, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``table`` where ``queries`` (a column over
    ``id_column``) holds, the k nearest other rows found, nearest first, ties to the smaller id."""
    spark = table.sparkSession
    rows = vectors.numbered(table.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").alias("vector")), "id", "vector")
    rows = rows.where(F.col("usable") & F.col("id").isNotNull())
    # the k + 1 smallest ids of each vector: the limit is applied before the shuffle, too
    few = rows.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("id", "row"))).where(F.col("at") <= k + 1)
    nodes = stage(few.groupBy("vector").agg(F.min("row").alias("node"), F.min("id").alias("first"), F.sort_array(F.collect_list(F.struct("id", "row"))).alias("ids")), "forest-nodes")
    asked = rows.select("row", F.col("id").alias(id_column), "vector").where(queries).select("row", F.col(id_column).alias("id"), "vector")
    asked = stage(asked.join(nodes.select("vector", "node"), "vector").select("row", "id", "node"), "forest-queries")
    ranked = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for length, count in vectors.lengths(nodes):
        ranked = ranked.unionByName(_ranked(nodes.where(F.size("vector") == length), count, asked, k))
    return ranked


def _ranked(nodes: DataFrame, count: int, asked: DataFrame, k: int) -> DataFrame:
    """The ranking of those queries whose vectors are among these, all of one length."""
    shared = Shared(nodes.sparkSession, fit(vectors.sampled(nodes, SAMPLE), k, leaves=leaves_for(count)))

    def placed(batches):
        for pdf in batches:
            x = unit_vectors(pdf["vector"])
            yield pdf.assign(cells=list(np.stack([t.place(x) for t in shared.value.trees], 1).astype(np.int32)))

    def visited(batches):
        for pdf in batches:
            x = unit_vectors(pdf["vector"])
            yield pdf.assign(visits=[[{"tree": t, "leaf": leaf} for t, leaf in shared.value.order(q, shared.value.visits)] for q in x])

    plain = nodes.select("node", "first", "vector")
    members = stage(plain.mapInPandas(placed, "node long, first long, vector array<double>, cells array<int>"), "forest-members")
    members = members.select("node", "first", "vector", F.lit(-2.0).alias("least"), F.posexplode("cells").alias("tree", "leaf"))
    seekers = plain.join(asked.select("node").distinct(), "node", "left_semi")
    seekers = stage(seekers.mapInPandas(visited, "node long, first long, vector array<double>, visits array<struct<tree:int,leaf:int>>"), "forest-seekers")

    def opened(some: DataFrame, visits) -> DataFrame:
        """(query, node, first, score) of what seekers (with ``least``) find in these of their leaves."""
        some = some.select("node", "first", "vector", "least", F.explode(visits).alias("v")).select("node", "first", "vector", "least", "v.tree", "v.leaf")
        units = vectors.blocked(members, some, ["tree", "leaf"], MEMBERS, VISITORS, ["node", "first", "vector", "least"])
        return units.groupBy("tree", "leaf", "i", "j").applyInPandas(_scored(k), "query long, node long, first long, score double")

    found = stage(opened(seekers.withColumn("least", F.lit(-2.0)), F.slice("visits", 1, FIRST)), "forest-found")
    ranks = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    least = found.groupBy("query", "node").agg(F.max("score").alias("score")).withColumn("at", F.row_number().over(ranks)).where(F.col("at") == k + 1)
    least = least.select(F.col("query").alias("node"), F.col("score").alias("bound"))
    bounded = seekers.join(least, "node", "left").withColumn("least", F.coalesce("bound", F.lit(-2.0)))
    found = found.unionByName(opened(bounded, F.slice("visits", FIRST + 1, F.greatest(F.size("visits") - FIRST, F.lit(0)))))
    best = found.groupBy("query", "node", "first").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    # only the nearest of all leaves a query opens go for their ids
    best = best.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).drop("at", "first").join(nodes.select("node", "ids"), "node")
    near = asked.select(F.col("id").alias("query_id"), F.col("row").alias("own"), F.col("node").alias("query")).join(best, "query")
    near = near.select("query_id", "own", F.explode("ids").alias("other"), "score").where("other.row <> own").select("query_id", "own", F.col("other.id").alias("vec_id"), "other.row", "score")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "row")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
