"""Near-duplicate vectors by an inverted multi-index.

A unit vector is cut into two halves with a codebook each, learned by k-means
on a bounded sample; the pairs of code words form a grid of cells. Every vector
lies in the cell of its nearest code words and, as a query, visits the cells that
a multi-sequence traversal (cheapest sum of the two squared distances first) meets
before the sum has grown by ``reach`` over its own cell's. That bound is where the
traversal reaches the target recall, on links in the sample and on random
neighbours of the sample that lie exactly at the threshold. As all cells before
the bound are visited, they are made by two sorted lists without a queue.
Every candidate is verified in double precision.

Equal vectors are one node. Cells with many members are cut into blocks and the
blocks compared two by two; a task hands on the number of links of each vector
and a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import lean, materialize
from prismset.llm.components import UnionFind, components
from prismset.session import table

MIN_COSINE = 0.9
#: Vectors that the codebooks and the reach are learned from (lowest hashes).
SAMPLE = 8192
#: Vectors that a cell of the grid should hold on average; gives the code words.
CELL_ROWS = 512
#: Share of links that the traversal must find, also of links at the threshold.
TARGET_RECALL = 0.99
#: Members of a cell, and visitors, that one task compares at once.
BLOCK = 2048


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Code words of the rows of x; at most as many as there are distinct rows."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    c = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        near = sq_distances(x, c).argmin(axis=1)
        c = np.array([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
    return c


def sq_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None])


class MultiIndex:
    """Two codebooks and the reach of the traversal."""

    def __init__(self, sample: np.ndarray, codes: int, min_cosine: float, recall: float, seed: int) -> None:
        self.half = sample.shape[1] // 2
        self.books = [kmeans(sample[:, : self.half], codes, seed), kmeans(sample[:, self.half :], codes, seed + 1)]
        away = np.random.default_rng(seed).standard_normal(sample.shape)
        away -= (away * sample).sum(1)[:, None] * sample
        away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
        growth = [self._growth(sample, min_cosine * sample + np.sqrt(1 - min_cosine**2) * away)]
        found = [np.zeros(0)]
        for i in range(0, len(sample), 1024):
            a, b = np.nonzero(sample[i : i + 1024] @ sample.T >= min_cosine)
            a = a + i
            a, b = a[a < b][:100_000], b[a < b][:100_000]
            found.append(self._growth(sample[a], sample[b]))
        growth.append(np.concatenate(found))
        self.reach = max(float(np.quantile(g, recall)) if len(g) else 0.0 for g in growth)

    def _growth(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How far the traversal must go for each link; it may start at either end."""
        both = []
        for q, t in ((x, y), (y, x)):
            d1, d2 = self.distances(q)
            there = self.cells(t)
            k = np.arange(len(q))
            both.append(d1[k, there // d2.shape[1]] + d2[k, there % d2.shape[1]] - d1.min(axis=1) - d2.min(axis=1))
        return np.minimum(*both)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return sq_distances(x[:, : self.half], self.books[0]), sq_distances(x[:, self.half :], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        d1, d2 = self.distances(x)
        return d1.argmin(axis=1) * len(self.books[1]) + d2.argmin(axis=1)

    def visited(self, x: np.ndarray) -> list[np.ndarray]:
        """The cells that the traversal meets from each vector up to the reach."""
        d1, d2 = self.distances(x)
        k2 = d2.shape[1]
        out = []
        for r1, r2 in zip(d1, d2, strict=True):
            o1, o2 = r1.argsort(), r2.argsort()
            s1, s2 = r1[o1] - r1[o1[0]], r2[o2] - r2[o2[0]]
            ends = np.searchsorted(s2, self.reach - s1[: np.searchsorted(s1, self.reach, "right")], "right")  # in each row of the sorted grid
            out.append(np.concatenate([o1[i] * k2 + o2[:n] for i, n in enumerate(ends)]))
        return out


def unit_rows(batch: pa.RecordBatch, column: int) -> np.ndarray:
    flat = batch.column(column)
    x = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(flat), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare(m: MultiIndex | None, cell: int, a: tuple, o: tuple, min_cosine: float, links: dict, uf: UnionFind) -> None:
    """Count and join the links between members ``a`` of a cell and rows ``o`` there.

    Both are (node, copies, vectors, home); rows at home count in their own turn
    as ``a``. A pair that each of two cells would see is counted in the cell with
    the smaller number. Rows known to be connected are not joined again.
    """
    node, copies, x, _ = a
    node_o, copies_o, y, home = o
    got, got_o = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    comp = np.arange(len(y))
    theirs = m.cells(y) if m else np.zeros(len(y), np.int64)
    for i in range(0, len(x), 512):
        q = x[i : i + 512]
        hit = q @ y.T >= min_cosine
        hit &= node[i : i + 512, None] != node_o[None]
        if not hit.any():
            continue
        if m:
            d1, d2 = m.distances(q)
            k2 = d2.shape[1]
            back = d1[:, theirs // k2] + d2[:, theirs % k2] - (d1.min(axis=1) + d2.min(axis=1))[:, None] <= m.reach
            hit &= home[None] | ~(back & (theirs < cell)[None])
        got[i : i + 512] += hit @ copies_o
        got_o += copies[i : i + 512] @ (hit & ~home[None])
        for r in np.flatnonzero(hit.any(axis=1)):
            new, at = np.unique(comp[hit[r]], return_index=True)
            others = np.flatnonzero(hit[r])[at]
            for j in others:
                uf.union(int(node[i + r]), int(node_o[j]))
            if len(new) > 1:
                comp[np.isin(comp, new)] = new[0]
    for ids, n in ((node, got), (node_o, got_o)):
        for k in np.flatnonzero(n):
            links[int(ids[k])] = links.get(int(ids[k]), 0) + int(n[k])


def near_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE, sample: int = SAMPLE, cell_rows: int = CELL_ROWS, recall: float = TARGET_RECALL, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, zero, empty or hold a null or non-finite component
    link with nothing, nor do vectors of different lengths. Copies link with each
    other (each counts the others) and have the links of their value. Rows with a
    null id are kept apart as unlinked. An empty table gives an empty result.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col("v")
    kind = "float" if "float" in df.schema[vector_col].dataType.simpleString() else "double"  # as stored; compared in double
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    rows = rows.withColumn("ok", F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0), F.lit(False)))
    nodes = materialize(rows.where("ok").groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "vectors")
    picked = nodes.orderBy(F.xxhash64("v"), "node").limit(sample).select("v").toArrow()["v"].to_pylist()  # bounded by sample
    codes = max(4, min(sample // 16, round((nodes.count() / cell_rows) ** 0.5)))
    by_size: dict[int, list] = {}
    for x in picked:
        by_size.setdefault(len(x), []).append(x)
    index = {}
    for size, xs in by_size.items():
        x = np.array(xs, np.float64)
        index[size] = MultiIndex(x / np.linalg.norm(x, axis=1, keepdims=True), codes, min_cosine, recall, seed)
    shared = spark.sparkContext.broadcast(index)  # two codebooks for each vector length in the sample

    def visits(batches: Iterator[pa.RecordBatch], rows: bool) -> Iterator[pa.RecordBatch]:
        """(size, cell, home) for every cell that a vector visits; with ``rows`` the vector too."""
        for b in batches:
            sizes = np.array([len(x) for x in b.column(0)])
            for size in np.unique(sizes):
                one = b.take(pa.array(np.flatnonzero(sizes == size)))
                x = unit_rows(one, 0)
                m = shared.value.get(int(size))
                seen = m.visited(x) if m else [np.zeros(1, np.int64)] * len(x)  # a length that the sample lacks is one cell
                own = m.cells(x) if m else np.zeros(len(x), np.int64)
                at = np.repeat(np.arange(len(x)), [len(s) for s in seen])
                cells = np.concatenate(seen)
                for p in range(0, len(at), 20_000):
                    i = at[p : p + 20_000]
                    cols = [pa.array(np.full(len(i), size, np.int32)), pa.array(cells[p : p + 20_000]), pa.array(cells[p : p + 20_000] == own[i])]
                    if rows:
                        cols += [one.column(k).take(pa.array(i)) for k in (1, 2, 0)]
                    yield pa.RecordBatch.from_arrays(cols, ["size", "cell", "home", "node", "copies", "v"][: len(cols)])

    base = nodes.select("v", "node", "copies")
    # rows of large cells are dealt into blocks: members by others, block against block
    loads = base.mapInArrow(lambda it: visits(it, False), "size int, cell long, home boolean").groupBy("size", "cell").agg(F.count_if("home").alias("members"), F.count("*").alias("all"))
    loads = loads.where("members > 0 and all > 1").select("size", "cell", F.ceil(F.col("members") / block).cast("int").alias("nm"), F.ceil(F.col("all") / block).cast("int").alias("no"))
    placed = base.mapInArrow(lambda it: visits(it, True), f"size int, cell long, home boolean, node long, copies long, v array<{kind}>").join(loads, ["size", "cell"])
    h = F.xxhash64("node")
    cols = ["size", "cell", "node", "copies", "v", "home"]
    as_member = placed.where("home").select(*cols, F.lit(True).alias("asks"), F.pmod(h, F.col("nm")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("no") - 1)).alias("j"))
    as_other = placed.select(*cols, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("nm") - 1)).alias("i"), F.pmod(h, F.col("no")).cast("int").alias("j"))
    keys = ["size", "cell", "i", "j"]
    dealt = as_member.unionByName(as_other).repartition(n, *keys).sortWithinPartitions(*keys).select(*keys, "asks", "node", "copies", "home", "v")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: dict[int, int] = {}
        uf = UnionFind()
        for size, cell, asks, node, copies, home, x in _cells(batches):
            if asks.any() and not asks.all():
                a, o = asks, ~asks
                _compare(shared.value.get(size), cell, (node[a], copies[a], x[a], home[a]), (node[o], copies[o], x[o], home[o]), min_cosine, links, uf)
            if len(links) > 200_000:
                yield _flush(links, uf)
                links, uf = {}, UnionFind()
        yield _flush(links, uf)

    found = materialize(dealt.mapInArrow(lambda it: lean(verify(it)), "node long, other long, links long"), "found")
    joined = components(found.where("other is not null").select("node", "other"))
    counts = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.join(counts, "node", "left").join(joined.withColumnRenamed("id", "node"), "node", "left")
    classes = classes.select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "node").alias("component_id"))
    good = rows.where("ok").join(classes, "v").select("vec_id", "n_links", "component_id")
    rest = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of one (size, cell, i, j) after the other from a sorted partition."""
    held: list[pa.RecordBatch] = []

    def out() -> tuple:
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        x = unit_rows(t, 8)
        return t.column(0)[0].as_py(), t.column(1)[0].as_py(), t.column(4).to_numpy(zero_copy_only=False), t.column(5).to_numpy(), t.column(6).to_numpy(), t.column(7).to_numpy(zero_copy_only=False), x

    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(j).to_numpy().astype(np.int64) for j in range(4)], axis=1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for s, e in zip(np.r_[0, cut], np.r_[cut, len(keys)], strict=True):
            if held and tuple(keys[s]) != last:
                yield out()
                held = []
            held.append(b.slice(int(s), int(e - s)))
            last = tuple(keys[s])
    if held:
        yield out()


def _flush(links: dict[int, int], uf: UnionFind) -> pa.RecordBatch:
    a, b = uf.forest()
    k = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array([*a, *links], pa.int64()), pa.array([*b, *[None] * len(links)], pa.int64()), pa.array([*[None] * k, *links.values()], pa.int64())],
        ["node", "other", "links"],
    )


def op1_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all ``embeddings`` at cosine 0.9 or more."""
    return near_embeddings(table(spark, sf_dir, "embeddings"))
