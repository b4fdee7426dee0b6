"""Near-duplicate documents by HyperMinHash registers, banded, estimated and verified on full sets.

A document's set is its distinct shingles of five words (``common.words``);
with fewer words, the whole sequence; without words, empty and linked with
nothing. Two documents are linked if 100 * intersection >= 75 * union.

1. Each distinct sequence of words is one node (copies never meet each other
   again). Of each of 128 hash functions the least value over the set is kept as
   its number of leading zeros and ten mantissa bits: 16 bits a register.
2. Four registers are a band; 32 bands miss a pair at the threshold with
   probability 5e-6. Nodes with an equal band form a bucket.
3. Every node of a bucket meets the bucket's first node. What passes the
   collision-corrected estimate is verified on the full sets.
4. Nodes that buckets connect form a neighbourhood. A bucket whose nodes now are
   all of one component is done. The nodes of the others are dealt into blocks,
   and two blocks meet if they share such a bucket: inside such a unit, pairs of
   different components that pass the estimate are verified on the full sets, and
   the unit returns at most one link for each two components it joins. Blocks hold
   a bounded number of nodes and shingles; two blocks of one component never meet.
   So a large group of near copies costs a verification each, not one for each
   pair, no pair leaves a unit, and no two nodes of a bucket that are linked end
   in different components.

Shingles are compared as 64-bit hashes. Null texts count as empty. Equal rows
are separate rows of one component. The smallest id stands for a component;
null ids never do, unless all are null. Columns of the input named like a
result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import batches_of, ship, vectorised, without, words
from ledgerweave.llm.components import components
from ledgerweave.session import stage

ship(__name__)

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: The estimate's standard error at the threshold is 0.038; five of them below it nothing is verified.
MARGIN = 5 * 0.0383
#: Nodes and shingles of a block when neighbourhoods of several components are compared, on average.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1_000_000


def _factors() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the hash functions, from one fixed generator."""
    draw = np.random.Generator(np.random.PCG64(20240229))
    return (draw.integers(0, 2**31, REGISTERS, np.uint32) * np.uint32(2) + np.uint32(1),
            draw.integers(0, 2**32, REGISTERS, np.uint32))


def shingles(found: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """The distinct shingles of a sequence of words as ascending 64-bit hashes."""
    import xxhash

    if not found:
        return np.empty(0, np.uint64)
    if len(known) > 200_000:  # what is kept for speed stays small
        known.clear()
    for w in set(found).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    size = min(SHINGLE, len(h))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k: len(h) - size + 1 + k] + np.uint64(size)
        out ^= out >> np.uint64(29)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        out = (out ^ (out >> np.uint64(30))) * np.uint64(factor)
    return np.unique(out ^ (out >> np.uint64(31)))


def registers(shingled: np.ndarray, factors) -> np.ndarray:
    """Leading zeros (6 bits) and mantissa (10 bits) of the least value under each hash function,
    which multiplies the upper half of the shingle's hash: 32 bits."""
    a, b = factors
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    half = (shingled >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(half), 2048):
        values = half[i:i + 2048] * a[:, None]
        values += b[:, None]
        np.minimum(least, values.min(1), out=least)
    fraction, bits = np.frexp(least.astype(np.float64))
    mantissa = np.where(fraction > 0, (fraction - 0.5) * 2048, 0)
    return ((32 - bits).astype(np.uint16) << np.uint16(10)) | mantissa.astype(np.uint16)


#: What _chance gave before; sizes are rounded, so these are few.
_CHANCES: dict[tuple[int, int], float] = {}


def _chance(n: int, m: int) -> float:
    """Probability that a register of two disjoint sets of 2^(n/4) and 2^(m/4) members is equal."""
    zeros = np.arange(33)[:, None]
    low = (1 + np.arange(1024)[None, :] / 1024) * 0.5 ** (zeros + 1)
    high = low + 0.5 ** (zeros + 11)
    p = [np.exp(size * np.log1p(-low)) - np.exp(size * np.log1p(-np.minimum(high, 1 - 1e-16))) for size in (2 ** (n / 4), 2 ** (m / 4))]
    return float((p[0] * p[1]).sum())


def _size_class(n: np.ndarray) -> np.ndarray:
    return np.rint(4 * np.log2(np.maximum(n, 1))).astype(int)


def _chances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """_chance of each two size classes, as a table over them."""
    for x in set(a.tolist()):
        for y in set(b.tolist()):
            if (x, y) not in _CHANCES:
                _CHANCES[x, y] = _CHANCES[y, x] = _chance(x, y)
    table = np.zeros((a.max(initial=0) + 1, b.max(initial=0) + 1))
    for x in set(a.tolist()):
        for y in set(b.tolist()):
            table[x, y] = _CHANCES[x, y]
    return table


def estimate(equal: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, without the chance collisions."""
    return (equal / REGISTERS - chance) / (1 - chance)


@vectorised("key binary, n long, bands array<long>")
def _sketch(texts):
    import hashlib

    import pandas as pd

    factors, known, out = _factors(), {}, []
    for text in texts:
        found = words(text)
        shingled = shingles(found, known)
        bands = registers(shingled, factors).view(np.int64) if found else np.empty(0, np.int64)
        out.append((hashlib.sha256(b" ".join(found)).digest(), len(shingled), bands))
    return pd.DataFrame(out, columns=["key", "n", "bands"])


@vectorised("boolean")
def _likely(a, b, n, m):
    import pandas as pd

    if not len(a):
        return pd.Series([], dtype=bool)
    x, y = (np.stack([np.asarray(v, np.int64) for v in s]).view(np.uint16) for s in (a, b))
    n, m = n.to_numpy(), m.to_numpy()
    i, j = _size_class(n), _size_class(m)
    likely = estimate((x == y).sum(1), _chances(i, j)[i, j]) >= PERCENT / 100 - MARGIN
    return pd.Series(likely & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)))


@vectorised("boolean")
def _linked(left, right):
    import pandas as pd

    known, out, last, mine = {}, [], None, None
    for a, b in zip(left, right, strict=True):
        if a != last:
            last, mine = a, shingles(words(a), known)
        other = shingles(words(b), known)
        both = len(np.intersect1d(mine, other, assume_unique=True))
        out.append(100 * both >= PERCENT * (len(mine) + len(other) - both))
    return pd.Series(out, dtype=bool)


# Tables that grow with the corpus are joined by merging: whether one is small enough for a broadcast
# would depend on the size of the corpus.

def _texts(sketch: DataFrame, wanted: DataFrame) -> DataFrame:
    return stage(sketch.select(F.col("row").alias("node"), F.col("doc.text").alias("text")).join(wanted.hint("merge"), "node", "left_semi"), "minhash-texts")


def _verified(pairs: DataFrame, nodes: DataFrame, sketch: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked: the estimate first, then the full sets."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bands").alias(f"s{x}"))
    pairs = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").where(_likely("sa", "sb", "na", "nb"))
    pairs = stage(pairs.select("a", "b"), "minhash-pairs")
    texts = _texts(sketch, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}"))
    return stage(pairs.join(side("b").hint("merge"), "b").join(side("a").hint("merge"), "a").where(_linked("ta", "tb")).select("a", "b"), "minhash-links")


def _between(unit):
    """Links that join components across the unit's two blocks, as (a, b); with one block, inside it."""
    import pandas as pd

    unit = unit.sort_values("node", kind="stable", ignore_index=True)
    regs = np.stack([np.asarray(v, np.int64) for v in unit["bands"]]).view(np.uint16)
    n, node, text = unit["n"].to_numpy(), unit["node"].to_numpy(), unit["text"].to_numpy()
    left, right = unit["left"].to_numpy(), unit["right"].to_numpy()
    size = _size_class(n)
    chance = _chances(size, size)
    _, comp = np.unique(unit["component"].to_numpy(), return_inverse=True)
    known: dict[bytes, int] = {}
    sets: dict[int, np.ndarray] = {}
    found = []
    for i in np.flatnonzero(left):
        j = np.flatnonzero(right & (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i])))
        if not len(j):
            continue
        near = j[estimate((regs[j] == regs[i]).sum(1), chance[size[i], size[j]]) >= PERCENT / 100 - MARGIN]
        for k in near.tolist():
            if comp[k] == comp[i]:
                continue
            for x in (i, k):
                if x not in sets:
                    sets[x] = shingles(words(text[x]), known)
            both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if 100 * both >= PERCENT * (n[i] + n[k] - both):
                found.append((node[i], node[k]))
                comp[comp == comp[k]] = comp[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _across(open_: DataFrame, nodes: DataFrame, sketch: DataFrame) -> DataFrame:
    """Links between different components of ``open_`` (node, area, component)."""
    banded = open_.join(nodes.select("node", "bands").hint("merge"), "node").select("node", "component", F.posexplode("bands").alias("band", "value"))
    mixed = banded.groupBy("band", "value").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    mixed = stage(banded.join(mixed.select("band", "value"), ["band", "value"]).select("node", "band", "value"), "minhash-mixed")
    open_ = open_.join(mixed.select("node").distinct(), "node", "left_semi")
    members = open_.join(nodes.select("node", "n", "bands").hint("merge"), "node")
    parts = F.greatest(F.ceil(F.col("count") / BLOCK_NODES), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sized = members.groupBy("area", "component").agg(F.count("*").alias("count"), F.sum("n").alias("shingles"))
    sized = sized.withColumn("parts", parts)
    # components of more than a block have blocks of their own, smaller ones share blocks
    small = sized.where("parts = 1").groupBy("area").agg(F.sum("count").alias("count"), F.sum("shingles").alias("shingles")).select("area", parts.alias("shared"))
    sized = sized.join(small, "area", "left").select("area", "component", "parts", "shared")
    own = F.col("parts") > 1
    placed = (members.join(sized, ["area", "component"]).withColumn("alone", own)
              .withColumn("block", F.when(own, F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("parts"))))
                          .otherwise(F.pmod(F.xxhash64("component"), F.col("shared")).cast("long"))))
    placed = stage(placed.select("area", "node", "component", "n", "bands", "alone", "block"), "minhash-blocks")
    # which blocks have nodes in which buckets; a block of one component names it, so that it meets no other of the same
    lone = F.when(F.col("alone"), F.col("component")).alias("lone")
    held = stage(mixed.join(placed.select("node", "area", "block", lone).hint("merge"), "node").drop("node").distinct(), "minhash-held")
    one, two = (held.select("area", "band", "value", F.col("block").alias(f"b{k}"), F.col("lone").alias(f"l{k}")) for k in (1, 2))
    meets = one.join(two, ["area", "band", "value"]).where("b1 <= b2 and (l1 = l2) is not true").select("area", "b1", "b2").distinct()
    meets = stage(meets, "minhash-meets")
    texts = _texts(sketch, open_.select("node"))
    whole = placed.join(texts.hint("merge"), "node")
    columns = ["area", "node", "component", "n", "bands", "text", "b1", "b2"]
    first = whole.withColumnRenamed("block", "b1").join(meets, ["area", "b1"]).select(*columns, F.lit(True).alias("left"), (F.col("b1") == F.col("b2")).alias("right"))
    second = whole.withColumnRenamed("block", "b2").join(meets.where("b1 < b2"), ["area", "b2"]).select(*columns, F.lit(False).alias("left"), F.lit(True).alias("right"))
    return stage(first.union(second).groupBy("area", "b1", "b2").applyInPandas(_between, "a long, b long"), "minhash-links")


def cluster(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_shingles, component_id (the least id reachable), kept (id = component_id)
    and first_of_component, true for exactly one row of each component."""
    batches_of(docs.sparkSession)
    results = ("n_shingles", "component_id", "kept", "first_of_component")
    columns = without(docs, *results).columns
    plain = F.struct(*[F.col(f"`{c}`") for c in columns], *([F.col(f"`{text}`").alias("text")] if text != "text" else []))
    sketch = stage(docs.select(plain.alias("doc"), F.col(f"`{id_column}`").alias("id"), _sketch(F.col(f"`{text}`")).alias("s"))
                   .select("doc", "id", F.monotonically_increasing_id().alias("row"), "s.*"), "minhash-sketch")
    worded = sketch.where("n > 0")
    nodes = stage(worded.groupBy("key").agg(F.min("row").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")), "minhash-nodes")
    banded = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("band", "value").agg(F.min("node").alias("first"), F.count("*").alias("size")).where("size > 1").drop("size")
    pairs = banded.join(shared, ["band", "value"]).where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stage(pairs, "minhash-stars")
    links = _verified(pairs, nodes, sketch)
    of = stage(components(links), "minhash-components")

    now: Column = F.coalesce("component", "node")
    area = components(pairs).withColumnRenamed("component", "area")
    area = stage(area.join(of, "node", "left").select("node", "area", now.alias("component")), "minhash-areas")
    several = area.groupBy("area").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    open_ = stage(area.join(several.select("area"), "area", "left_semi"), "minhash-open")
    if not open_.isEmpty():
        of = stage(components(links.union(_across(open_, nodes, sketch))), "minhash-components")

    member = (sketch.select("row", "id", "key", "n").join(nodes.select("key", "node"), "key", "left")
              .join(of, "node", "left").select("row", "id", F.when(F.col("n") > 0, now).otherwise(F.col("row")).alias("component")))
    member = stage(member, "minhash-members")
    # the least id stands for the component, null ids last, then the least row
    first = member.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    result = member.join(first, "component").select(
        "row", F.col("first.id").alias("component_id"), F.coalesce(F.col("id") == F.col("first.id"), F.lit(False)).alias("kept"),
        (F.col("row") == F.col("first.row")).alias("first_of_component"))
    return sketch.join(result, "row").select(*[F.col(f"doc.`{c}`") for c in columns], F.col("n").alias("n_shingles"), "component_id", "kept", "first_of_component")
