"""Integer k-means whose assignments are filtered by PCA-rotated coordinates.

Components are turned into integers, and all sums, distances and centroids are
integers. A rotation onto the principal axes is fitted on a bounded sample.
Every vector is stored with its leading rotated coordinates and the norm of what
is left of it. For a vector x and a centroid c, the squared distance of their
leading coordinates plus the squared difference of their residual norms is never
more than |x - c|^2. The centroid with the least bound is tried first; only
centroids whose bound does not exceed its exact distance are verified, in
integers. The rotation is in floating point and only ever filters: the bounds
are lowered by more than their rounding error, so the sample and the number of
leading coordinates change the work but no result.

A round hands on one row of sums per cluster and task, whatever the number of
vectors in a cluster.

Kept are vectors with exactly ``length`` components, none null or non-finite;
no other row is in the result. Repeated rows count as often as they occur. A null
id hashes as the empty text; among equal hashes the componentwise smaller vector
comes first. With fewer than ``k`` vectors there are as many centroids. Components
beyond 2^26 in integers stop the job, since distances would leave 64 bits.
Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import id_text, ship, without
from ledgerweave.session import stage

ship(__name__)

#: Vectors the rotation is fitted on, about.
SAMPLE = 8192
LEADING = 24
LARGEST = 1 << 26


@dataclass
class Filter:
    """Centroids with what the lower bound needs of them."""

    axes: np.ndarray  # length x leading, orthonormal columns
    mean: np.ndarray
    centroids: np.ndarray  # k x length, int64

    def __post_init__(self) -> None:
        self.heads, self.rests = self.rotate(self.centroids)

    def rotate(self, ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading rotated coordinates, and the norm of the residual."""
        x = ints - self.mean
        head = x @ self.axes
        return head, np.sqrt(np.maximum((x * x).sum(1) - (head * head).sum(1), 0.0))

    def bounds(self, head: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances to every centroid, less the rounding error."""
        h2, c2 = (head * head).sum(1), (self.heads * self.heads).sum(1)
        apart = h2[:, None] - 2.0 * (head @ self.heads.T) + c2[None] + (rest[:, None] - self.rests[None]) ** 2
        size = (h2 + rest * rest)[:, None] + (c2 + self.rests * self.rests)[None]
        # a residual norm comes from a difference of squares: it is right to about 1e-7 of the vector's norm
        return apart - 1e-6 * size - 1e-6

    def nearest(self, ints: np.ndarray, head: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid of each vector (ties: smaller number), its squared distance, and how many were verified."""
        bound = self.bounds(head, rest)
        first = bound.argmin(1)
        who, best = first.copy(), ((ints - self.centroids[first]) ** 2).sum(1)
        open_ = bound <= best[:, None]
        open_[np.arange(len(first)), first] = False
        tried = len(first)
        for j in np.flatnonzero(open_.any(0)):
            rows = np.flatnonzero(open_[:, j] & (bound[:, j] <= best))
            d = ((ints[rows] - self.centroids[j]) ** 2).sum(1)
            tried += len(rows)
            won = (d < best[rows]) | ((d == best[rows]) & (j < who[rows]))
            who[rows[won]], best[rows[won]] = j, d[won]
        return who, best, tried


def principal(ints: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal axes of a sample."""
    mean = ints.mean(0)
    _, axes = np.linalg.eigh(np.cov((ints - mean).T, bias=True).reshape(ints.shape[1], ints.shape[1]))
    return mean, np.ascontiguousarray(axes[:, ::-1][:, :leading])


def _matrix(column, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind, copy=False)


def _rotated(model: Filter, length: int):
    """Arrow function: leading coordinates and residual norm of integer vectors, as one array each."""

    def run(ints):
        import pyarrow as pa

        head, rest = model.rotate(_matrix(ints, length, np.int64))
        both = np.hstack([head, rest[:, None]])
        offsets = np.arange(len(both) + 1, dtype=np.int32) * both.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(both.ravel()))

    return F.arrow_udf(run, "array<double>")


def _assigned(model: Filter, length: int):
    """Arrow function: (cluster, distance) of vectors with their stored coordinates."""

    def run(ints, stored):
        import pyarrow as pa

        kept = _matrix(stored, model.axes.shape[1] + 1, np.float64)
        who, best, _ = model.nearest(_matrix(ints, length, np.int64), kept[:, :-1], kept[:, -1])
        return pa.StructArray.from_arrays([pa.array(who.astype(np.int32)), pa.array(best)], ["cluster", "distance"])

    return F.arrow_udf(run, "struct<cluster:int,distance:bigint>")


def _sums(model: Filter, length: int):
    """One row of (cluster, n, sums) for each cluster that occurs in a task."""

    def run(batches):
        import pyarrow as pa

        k = len(model.centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, length), np.int64)
        for batch in batches:
            ints = _matrix(batch.column("ints"), length, np.int64)
            kept = _matrix(batch.column("stored"), model.axes.shape[1] + 1, np.float64)
            who, _, _ = model.nearest(ints, kept[:, :-1], kept[:, -1])
            for j in np.unique(who):
                mine = who == j
                n[j] += mine.sum()
                total[j] += ints[mine].sum(0)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(found.astype(np.int32)), "n": pa.array(n[found]),
            "sums": pa.array(total[found].tolist(), pa.list_(pa.int64()))})

    return run


def integers(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component."""
    def one(x: Column) -> Column:
        y = F.floor(F.lit(float(scale)) * x)
        return F.when(F.abs(x) * scale <= LARGEST, y).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST} in integers"))).cast("int")

    return F.transform(vector.cast("array<double>"), one)


def keeps(vector: Column, length: int) -> Column:
    finite = F.forall(vector.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == length) & finite, F.lit(False))


def _moved(centroids: np.ndarray, partial: DataFrame) -> np.ndarray:
    """Centroids replaced by the floors of their vectors' means; at most k * length rows come to the driver."""
    cells = partial.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    sums = cells.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    moved = centroids.copy()
    for row in sums.collect():
        moved[row["cluster"], row["at"]] = int(row["total"]) // row["n"]
    return moved


def cluster(
    table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, length: int = 64,
    scale: int = 64, seed: int = 1, leading: int = LEADING,
) -> DataFrame:
    """The kept rows of ``table`` with cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    table = without(table, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    columns = table.columns
    given = F.col(f"`{vector}`")
    kept = table.where(keeps(given, length)).select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), integers(given, scale).alias("ints"),
        F.sha2(F.concat(F.lit(f"{seed}:"), id_text(f"`{id_column}`")), 256).alias("place"),
        F.monotonically_increasing_id().alias("row"))
    kept = stage(kept, "pca-integers")
    first = kept.select("place", "ints").orderBy("place", "ints").limit(k).collect()
    result = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return kept.select("doc.*", *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in result.split(", ")])
    share = max(1, int((1 << 20) * min(1.0, SAMPLE / kept.count())))
    drawn = kept.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < share).select("ints").toArrow()["ints"].combine_chunks()
    centroids = np.array([r["ints"] for r in first], np.int64)
    mean, axes = principal(_matrix(drawn, length, np.float64) if len(drawn) > 1 else centroids.astype(float), min(leading, length))
    model = Filter(axes, mean, centroids)
    vectors = stage(kept.select("doc", "ints", _rotated(model, length)("ints").alias("stored")), "pca-vectors")
    for _ in range(rounds):
        partial = vectors.select("ints", "stored").mapInArrow(_sums(model, length), "cluster int, n bigint, sums array<bigint>")
        model = Filter(axes, mean, _moved(model.centroids, partial))
    done = stage(vectors.select("doc", _assigned(model, length)("ints", "stored").alias("at")).select("doc", "at.*"), "pca-clusters")
    # a row for each of the k clusters
    within = {r["cluster"]: r["inertia"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in model.centroids.tolist()]
    of = lambda values: F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("cluster"))
    return done.select(
        *[F.col(f"doc.`{c}`") for c in columns], "cluster", "distance", of(within).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(within.values())).cast("bigint").alias("inertia"), of({j: digest[j] for j in within}).alias("centroid_sha256"))


def oracle(k: int = 16, rounds: int = 3, length: int = 64) -> str:
    """The same clustering in plain SQL: every vector against every centroid."""
    near = """
    d{r} AS MATERIALIZED (
      SELECT v.r, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
      FROM x v JOIN c{r} c ON v.i = c.i GROUP BY v.r, c.cluster),
    n{r} AS MATERIALIZED (
      SELECT r, cluster, distance FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY distance, cluster) AS p FROM d{r}) WHERE p = 1)"""
    move = """
    s{r} AS MATERIALIZED (
      SELECT n.cluster, x.i, CAST(sum(x.x) AS BIGINT) AS s, count(*) AS n FROM n{r} n JOIN x ON n.r = x.r GROUP BY n.cluster, x.i),
    c{q} AS MATERIALIZED (
      SELECT c.cluster, c.i, CASE WHEN s.n IS NULL THEN c.x ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
      FROM c{r} c LEFT JOIN s{r} s ON c.cluster = s.cluster AND c.i = s.i)"""
    steps = [near.format(r=0)]
    for r in range(rounds):
        steps += [move.format(r=r, q=r + 1), near.format(r=r + 1)]
    return f"""
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id) - 1 AS r, vec_id, embedding
      FROM embeddings
      WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(CAST(e AS DOUBLE)))) = 0),
    x AS MATERIALIZED (
      SELECT r, generate_subscripts(embedding, 1) AS i, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v),
    c0 AS MATERIALIZED (SELECT r AS cluster, i, x FROM x WHERE r < {k}),
    {",".join(steps)},
    w AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM n{rounds} GROUP BY cluster),
    h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
    SELECT v.vec_id, CAST(n.cluster AS INTEGER) AS cluster, n.distance, w.cluster_inertia,
      (SELECT CAST(sum(distance) AS BIGINT) FROM n{rounds}) AS inertia, h.centroid_sha256
    FROM v JOIN n{rounds} n ON v.r = n.r JOIN w ON n.cluster = w.cluster JOIN h ON n.cluster = h.cluster"""
