"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are halved; each half has its own codebook, fitted by k-means on a
bounded sample, and the product of the two codebooks is a grid of cells. A
vector visits cells in order of the summed squared distances of its halves, by
multi-sequence traversal, until the cost exceeds that of its nearest cell by a
margin. The margin is measured on the sample: pairs at exactly the threshold
must be met from one side or the other with the target recall (closer pairs are
met more often). What meets is verified by cosine in double precision.

Equal vectors are one node with a count. A cell of any size is worked off in
blocks of members and visitors; a block returns, for each vector, the number of
its links and the smallest node it is connected with inside the block, never the
pairs. Components are then joined over all blocks.

The grid grows with the table, so that a cell holds PER_CELL vectors on average,
until the codebooks have as many codes as the sample can fit. Vectors of different
lengths have no cosine; each length has an index of its own, one after another.

Vectors that are null, zero or hold null or non-finite components link with
nothing. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm import vectors
from ledgerweave.llm.common import Shared, ship, without
from ledgerweave.llm.components import components
from ledgerweave.llm.vectors import unit as unit_vectors
from ledgerweave.session import stage

ship(__name__)

THRESHOLD, RECALL = 0.9, 0.995
#: Vectors the codebooks and the margin are fitted on, at most.
SAMPLE = 20_000
#: Least codes of a half, sample vectors for each code at least, and vectors in a cell on average.
CODES, PER_CODE, PER_CELL = 16, 40, 128
MEMBERS, VISITORS = 1024, 2048


@dataclass
class Index:
    halves: tuple[np.ndarray, np.ndarray]
    margin: float = 0.0

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to their codes."""
        cut = x.shape[1] // 2
        return tuple(((h ** 2).sum(1)[:, None] - 2 * h @ c.T + (c ** 2).sum(1)[None]) for h, c in zip((x[:, :cut], x[:, cut:]), self.halves, strict=True))

    def cell(self, costs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return costs[0].argmin(1) * len(self.halves[1]) + costs[1].argmin(1)

    def excess(self, costs: tuple[np.ndarray, np.ndarray], cells: np.ndarray) -> np.ndarray:
        """How much more each vector's given cell costs than its nearest one."""
        at = np.arange(len(cells))
        a, b = np.divmod(cells, len(self.halves[1]))
        return costs[0][at, a] - costs[0].min(1) + costs[1][at, b] - costs[1].min(1)

    def visits(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Multi-sequence traversal of one vector's grid, nearest cell first, up to the margin."""
        a, b = first.argsort(kind="stable"), second.argsort(kind="stable")
        limit = first[a[0]] + second[b[0]] + self.margin
        queue, pushed, found = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, []
        while queue:
            cost, i, j = heapq.heappop(queue)
            if cost > limit:
                break
            found.append(int(a[i]) * len(second) + int(b[j]))
            for p, q in ((i + 1, j), (i, j + 1)):
                if p < len(a) and q < len(b) and (p, q) not in pushed:
                    pushed.add((p, q))
                    heapq.heappush(queue, (first[a[p]] + second[b[q]], p, q))
        return found


def _codebook(x: np.ndarray, codes: int, draw: np.random.Generator) -> np.ndarray:
    """Centroids by Lloyd's k-means from a random start."""
    c = x[draw.permutation(len(x))[:codes]].copy()
    for _ in range(15):
        near = ((c ** 2).sum(1)[None] - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        for k in np.flatnonzero(n):
            c[k] = x[near == k].mean(0)
    return c


def fit(x: np.ndarray, codes: int = CODES, threshold: float = THRESHOLD, recall: float = RECALL) -> Index:
    """Codebooks and margin from the unit vectors of a sample."""
    draw = np.random.Generator(np.random.PCG64(7))
    cut = x.shape[1] // 2
    index = Index((_codebook(x[:, :cut], codes, draw), _codebook(x[:, cut:], codes, draw)))
    near = draw.standard_normal(x.shape)
    near -= (near * x).sum(1, keepdims=True) * x
    near = threshold * x + np.sqrt(1 - threshold ** 2) * near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-12)
    mine, other = index.costs(x), index.costs(near)
    met = np.minimum(index.excess(mine, index.cell(other)), index.excess(other, index.cell(mine)))
    index.margin = float(np.quantile(met, recall)) + 1e-9
    return index


def codes_for(vectors_in_all: int) -> int:
    """Codes of each half for a table of that many different vectors."""
    return max(CODES, min(math.isqrt(vectors_in_all // PER_CELL), SAMPLE // PER_CODE))


def _linked(index: Index, threshold: float):
    def run(unit):
        import pandas as pd

        member = unit["member"].to_numpy()
        node, count = unit["node"].to_numpy(), unit["n"].to_numpy()
        x = unit_vectors(unit["vector"])
        m, v = np.flatnonzero(member), np.flatnonzero(~member)
        links, root = np.zeros(len(node), np.int64), node.copy()
        if len(m) and len(v):
            near = (x[v] @ x[m].T >= threshold) & (node[v][:, None] != node[m][None])
            # a pair is met here as (visitor, member), and perhaps in the visitor's cell the other way
            # round; there it counts if the member is the smaller node and really visits that cell
            costs = index.costs(x)
            home = index.cell(costs)
            for i in np.flatnonzero(near.any(1)):
                js = np.flatnonzero(near[i] & (node[m] < node[v[i]]))
                mine = tuple(c[m[js]] for c in costs)
                back = index.excess(mine, np.full(len(js), home[v[i]])) <= index.margin
                near[i, js[back]] = False
            links[v], links[m] = near @ count[m], near.T @ count[v]
            while True:  # the smallest node connected inside the block
                big = np.iinfo(np.int64).max
                low_v = np.minimum(root[v], np.where(near, root[m][None], big).min(1))
                low_m = np.minimum(root[m], np.where(near, low_v[:, None], big).min(0))
                same = (low_v == root[v]).all() and (low_m == root[m]).all()
                root[v], root[m] = low_v, low_m
                if same:
                    break
        found = links > 0
        return pd.DataFrame({"node": node[found], "links": links[found], "root": root[found]})

    return run


def _links(nodes: DataFrame, count: int, threshold: float) -> DataFrame:
    """Written (node, links, root) of different vectors of one length, several rows a node."""
    index = fit(vectors.sampled(nodes, SAMPLE), codes_for(count), threshold)
    shared = Shared(nodes.sparkSession, index)

    def placed(batches):
        import pandas as pd

        for pdf in batches:
            costs = shared.value.costs(unit_vectors(pdf["vector"]))
            home = shared.value.cell(costs)
            visits = [shared.value.visits(a, b) for a, b in zip(*costs, strict=True)]
            yield pd.DataFrame({"node": pdf["node"], "n": pdf["n"], "vector": pdf["vector"], "home": home, "visits": visits})

    cells = stage(nodes.mapInPandas(placed, "node long, n long, vector array<double>, home int, visits array<int>"), "vector-cells")
    columns = ["node", "n", "vector"]
    units = vectors.blocked(cells.select(F.col("home").alias("cell"), *columns), cells.select(F.explode("visits").alias("cell"), *columns), ["cell"], MEMBERS, VISITORS, columns)
    return stage(units.groupBy("cell", "i", "j").applyInPandas(_linked(index, threshold), "node long, links long, root long"), "vector-links")


def near_duplicates(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``table`` with n_links, component_id (the smallest id reachable) and kept (id = component_id)."""
    spark = table.sparkSession
    table = without(table, "n_links", "component_id", "kept")
    columns = table.columns
    packed = table.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").alias("given"))
    rows = vectors.numbered(packed.select(F.struct("doc", "id").alias("id"), "given"), "id", "given")
    flat = rows.select("row", F.col("id.doc").alias("doc"), F.col("id.id").alias("id"), "vector", "usable")
    # equal vectors meet by their content; the count is a partial aggregate
    nodes = stage(flat.where("usable").groupBy("vector").agg(F.min("row").alias("node"), F.count("*").alias("n")), "vector-nodes")
    found = spark.createDataFrame([], "node long, links long, root long")
    for length, count in vectors.lengths(nodes):
        if count > 1:
            found = found.unionByName(_links(nodes.where(F.size("vector") == length), count, threshold))
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = stage(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "vector-components")
    member = flat.where("usable").select("row", "id", "vector").join(nodes, "vector")
    member = (member.join(degree, "node", "left").join(of, "node", "left")
              .select("row", "id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")))
    member = stage(member, "vector-members")
    least = member.groupBy("component").agg(F.min("id").alias("component_id"))
    result = member.join(least, "component").select("row", "n_links", "component_id")
    return flat.join(result, "row", "left").select(
        *[F.col(f"doc.`{c}`") for c in columns], F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))
