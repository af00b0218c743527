"""Connected components of an edge table, without collecting links anywhere.

Edges are first reduced inside each partition to a spanning forest (union-find
in bounded chunks), then alternating small-star and large-star rounds rewire
every node to the smallest node of its component. A round is two groupings and
two joins on the node, so a node with very many neighbours is a skewed join key
that the adaptive planner splits, never one task's list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismset.llm.common import discard, lean, materialize

#: Edges that one union-find pass holds at once.
CHUNK_EDGES = 1_000_000
#: Edges that make a node a hub at least; hubs that are sent to every task at most
#: (about: a table has twice its rows over the bound as hubs).
HUB_ROWS = 200
MAX_HUBS = 50_000


class UnionFind:
    """Union-find over arbitrary integers; the root is the smallest member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True

    def forest(self) -> tuple[list[int], list[int]]:
        """Every member but the roots, with its root."""
        nodes = [x for x in self.up if self.find(x) != x]
        return nodes, [self.up[x] for x in nodes]


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a partition by spanning stars of its chunks."""

    def stars() -> pa.RecordBatch:
        nodes, roots = uf.forest()
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["u", "v"])

    uf, held = UnionFind(), 0
    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            uf.union(x, y)
        held += b.num_rows
        if held >= CHUNK_EDGES:
            yield stars()
            uf, held = UnionFind(), 0
    yield stars()


def _onto_least(rows: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """``rows`` (u, v) with the ``m`` of their u from ``least`` (u, m, n).

    Nodes with over ``hub`` rows, of which there are only few, are looked up in each
    task, so that their rows do not meet in one.
    """
    hubs = F.broadcast(least.where(F.col("n") > hub).select("u", "m"))  # at most rows / hub, see components
    others = rows.join(hubs.select("u"), "u", "left_anti").join(least.where(F.col("n") <= hub).select("u", "m"), "u")
    return rows.join(hubs, "u").unionByName(others)


def _to_min(e: DataFrame, hub: int) -> DataFrame:
    """Small star: each node and its smaller neighbours point at the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _onto_least(e, least, hub).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _spread(e: DataFrame, hub: int) -> DataFrame:
    """Large star: the larger neighbours of each node point at its smallest neighbour."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _onto_least(both.where("v > u"), least, hub).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(id, component_id) for every node of ``edges`` (two long columns).

    ``component_id`` is the smallest node reachable. Nulls and self links are
    ignored; an empty edge table gives an empty result. The rounds needed grow
    with the logarithm of a component's size.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u > v")
    held = materialize(e.mapInArrow(lambda it: lean(local_forest(it)), "u long, v long"), "links")
    for _ in range(max_rounds):
        mixed = held.join(held.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        twice = mixed or held.groupBy("u").count().where("count > 1").limit(1).count()
        if not twice:
            return held.select(F.col("u").alias("id"), F.col("v").alias("component_id")).distinct().unionByName(
                held.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
            )
        hub = max(HUB_ROWS, held.count() // MAX_HUBS)
        wide = materialize(_spread(held, hub), "links")
        old, held = held, materialize(_to_min(wide, hub), "links")
        discard(wide)
        discard(old)
    raise RuntimeError("the components did not settle")
