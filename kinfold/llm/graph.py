"""Connected components over edge tables, by alternating star contractions.

All state is in tables on the shared folder; nothing but row counts and one checksum per
round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import discard, join_dealt, materialize


#: Edges that one task can hold anyway (two numbers each); only beyond them hubs are dealt with apart.
FEW = 1_000_000


def _star(edges: DataFrame, larger: bool, hubs: bool) -> DataFrame:
    """Links each neighbour to the least node around a node.

    ``larger``: neighbours above the node move to the least neighbour or the node itself;
    otherwise the neighbours below it, and the node, move to the least of them. Rows are
    joined to one row per node, and where there may be ``hubs``, nodes with very many
    neighbours, those by broadcast, so none is ever gathered.
    """
    join = (lambda rows, least: join_dealt(rows, least, ["u"], "n")) if hubs else (lambda rows, least: rows.join(least, "u"))
    if larger:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        moved = join(edges, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        moved = join(edges, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 60, few: int = FEW) -> DataFrame:
    """(node, root) of every node with an edge (columns ``u``, ``v``); root: the least node reachable.

    Loops and repeated edges do no harm. The number of rounds grows with the logarithm of
    the longest path; not settling within ``rounds`` is an error, never a partial result.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    mark = lambda e: e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    before = mark(edges)
    for _ in range(rounds):
        hubs, old = before[0] > few, [edges]
        half = _star(edges, True, hubs)
        if hubs:  # read several times
            half = materialize(half, "edges")
            old.append(half)
        edges = materialize(_star(half, False, hubs), "edges")
        discard(*old)
        after = mark(edges)
        if after == before:
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")
