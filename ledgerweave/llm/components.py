"""Connected components of a graph given as a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.session import stage


def _towards_least(links: DataFrame, small: bool) -> DataFrame:
    """Each node hands the least node around it to its larger (or, if ``small``, its smaller) neighbours.

    ``links``: node, other, with other < node. The least neighbour is a partial
    aggregate, so a node with very many links is never one group.
    """
    ways = links if small else links.union(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    least = ways.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    met = ways.join(least, "node")
    if small:
        handed = met.select(F.col("other").alias("node"), "least").union(least)
    else:
        handed = met.where("other > node").select(F.col("other").alias("node"), "least")
    return handed.where("node > least").select("node", F.col("least").alias("other")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node that has a link; the component is its smallest node.

    Loops, repeated links and either direction are allowed; links with a null end
    are left out. The number of rounds grows with the logarithm of the longest
    chain. Every round is a written table.
    """
    links = links.where(f"{a} <> {b}").select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
    links = stage(links.distinct(), "links")
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == before:
            break
        before = mark
        for small in (False, True):  # both read their links twice, so each is written
            links = stage(_towards_least(links, small), "links")
    roots = links.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    return links.select("node", F.col("other").alias("component")).union(roots)
