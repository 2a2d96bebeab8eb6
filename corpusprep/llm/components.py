"""Connected components of a graph that is too large for one machine: distributed union-find.

Edges are first contracted inside each partition by an ordinary union-find of bounded size, which leaves few edges per node. Then rounds
of two steps follow: every node sends its larger neighbours to its smallest neighbour (large star), and every node sends
its smaller neighbours and itself to the smallest (small star). Both keep components as they are. When a round changes
nothing, every node points at the smallest node of its component. Each step is written to the shared folder, so a lost
executor costs no more than that step. Smallest neighbours are minima, which tasks work out before anything is shuffled;
a node with very many neighbours is one row of a join, whose other side adaptive execution can split.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.work import written

MAX_ROUNDS = 60
#: Nodes that a contracting task holds; then it hands on what it has and begins anew. Results do not depend on it.
HELD_NODES = 500_000


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (node, root) that connect what the edges of a partition connect, one for each node among ``HELD_NODES``."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def contracted() -> pd.DataFrame:
        nodes = [x for x in parent if parent[x] != x]
        return pd.DataFrame({"u": nodes, "v": [root(x) for x in nodes]}, dtype="int64")

    for frame in frames:
        for a, b in zip(frame["u"].tolist(), frame["v"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > HELD_NODES:
            yield contracted()
            parent.clear()
    yield contracted()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u bigint, v bigint); root is the smallest node of the component.

    Direction, repeats, and edges from a node to itself do not matter, nulls are left out. Nodes without an edge to
    another node do not appear. An empty table gives an empty result.
    """
    edges = edges.select("u", "v").where("u <> v")
    edges = written(edges.mapInPandas(_contract, "u bigint, v bigint").distinct(), "edges")
    before = _signature(edges)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
