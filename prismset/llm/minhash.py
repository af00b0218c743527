"""Candidates by MinHash bands, exact Jaccard links among them, and their components.

Texts are compared by sets of 64-bit codes. MinHash signatures are cut into bands;
texts that share a band meet in its group. In a first round every text of a group
is compared with the group's first one only. Texts that this leaves in different
components of one group are compared with each other in a second round, so dense
groups cost about their size and no pair of similar texts that shares a band is
lost. Links are verified by exact Jaccard similarity of the code sets.

The (band, id) rows of a task travel in blocks of bytes, one for each partition
they are dealt to, and are sorted there in numpy, or on scratch files if they are
many. Texts are fetched for candidates only; a bitmap of their ids, of bounded
size, keeps most others from being sent, an exact join the rest.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismset.llm.common import discard, lean, materialize
from prismset.llm.components import components

#: Texts to their codes, repeats allowed.
Codes = Callable[[list[bytes]], list[np.ndarray]]
#: (band, id) pairs that a task gathers before it sends them, pairs sorted in memory
#: at once, files that more of them are spread over.
SENT = 1 << 20
SORTED = 1 << 21
FILES = 16
#: Logarithm of the largest bitmap (16 MB), bits for each id as long as that allows.
BITMAP = 27
BITS_PER_ID = 16
#: Texts of a group, and bytes of them, that one task compares with as many others;
#: bytes of texts whose codes are made at once; columns of an incidence matrix.
BLOCK = 500
BLOCK_BYTES = 1 << 21
CODED = 1 << 20
COLUMNS = 4096
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def band_keys(code: np.ndarray, first: np.ndarray, count: int, rows: int) -> np.ndarray:
    """(set, band) keys from MinHash signatures of ``count`` times ``rows`` permutations.

    ``code`` holds the hashed members of all sets, ``first`` where each set begins;
    no set is empty. Every value has a permutation of its own, whatever the size of
    the set, so a pair at Jaccard j shares a band with 1 - (1 - j^rows)^count.
    """
    low = (code >> np.uint64(16)).astype(np.uint32)
    odd = np.random.default_rng(20).integers(0, 1 << 31, (count, rows), np.uint32) * np.uint32(2) + np.uint32(1)
    out = np.zeros((len(first), count), np.uint64)
    for b in range(count):
        key = np.full(len(first), b + 1, np.uint64)
        for r in range(rows):
            key = (key ^ np.minimum.reduceat(low * odd[b, r], first)) * GOLDEN
            key ^= key >> np.uint64(31)
        out[:, b] = key
    return out


def jaccard(a: frozenset, b: frozenset) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def _sent(signed: Iterator[tuple[np.ndarray, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """(part, block) of the (band, id) pairs of (ids, keys of all bands)."""

    def out() -> pa.RecordBatch:
        x = np.concatenate(held)
        part = (x[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int32)
        o = np.argsort(part, kind="stable")
        x, part = x[o], part[o]
        cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        return pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array([b.tobytes() for b in np.split(x, cut[1:])], pa.binary())], ["part", "block"])

    held, size = [], 0
    for ids, keys in signed:
        held.append(np.stack([keys.ravel().view(np.int64), np.repeat(ids, keys.shape[1])], axis=1))
        size += len(held[-1])
        if size >= SENT:
            yield out()
            held, size = [], 0
    if size:
        yield out()


def _sorted(blocks: Iterator[np.ndarray], most: int, level: int = 0) -> Iterator[np.ndarray]:
    """Distinct (band, id) pairs in order; all of a band are in one array."""

    def ordered() -> np.ndarray:
        x = np.concatenate(held) if held else np.zeros((0, 2), np.int64)
        x = x[np.lexsort((x[:, 1], x[:, 0]))]
        return x[np.r_[True, (x[1:] != x[:-1]).any(axis=1)]] if len(x) else x

    def spill() -> None:
        x = ordered()
        k = (x[:, 0].view(np.uint64) * GOLDEN >> np.uint64(60 - 4 * level)).astype(int) % FILES
        for j, f in enumerate(files):
            f.write(x[k == j].tobytes())

    held, size = [], 0
    files: list = []
    for x in blocks:
        held.append(x)
        size += len(x)
        if size > most and level < 4:
            files = files or [tempfile.TemporaryFile() for _ in range(FILES)]  # scratch of this task attempt
            spill()
            held, size = [], 0
    if not files:
        yield ordered()
        return
    spill()
    held = []
    for f in files:
        f.seek(0)
        yield from _sorted(_reread(f), most, level + 1)
        f.close()


def _reread(f) -> Iterator[np.ndarray]:
    while b := f.read(1 << 24):
        yield np.frombuffer(b, np.int64).reshape(-1, 2)


def _members(batches: Iterator[pa.RecordBatch], most: int = SORTED) -> Iterator[pa.RecordBatch]:
    """(grp, id, first) of bands with several ids; grp is null for two of them.

    Bands with the same ids get the same ``grp``.
    """
    blocks = (np.frombuffer(b, np.int64).reshape(-1, 2) for x in batches for b in x.column(1).to_pylist())
    for x in _sorted(blocks, most):
        if not len(x):
            continue
        start = np.flatnonzero(np.r_[True, x[1:, 0] != x[:-1, 0]])
        n = np.diff(np.r_[start, len(x)])
        mixed = x[:, 1].view(np.uint64) * GOLDEN
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        grp = np.add.reduceat(mixed ^ mixed >> np.uint64(32), start).view(np.int64)
        several = np.repeat(n > 1, n)
        grp, first, two = (np.repeat(v, n)[several] for v in (grp, x[start, 1], n == 2))
        ids = x[several, 1]
        for k in range(0, len(ids), 100_000):
            s = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(grp[s], mask=two[s]), pa.array(ids[s]), pa.array(first[s])], ["grp", "id", "first"])


def candidates(df: DataFrame, sign: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]], name: str) -> DataFrame:
    """(grp, id, first) of the texts of ``df`` that share a band with another one.

    ``sign`` makes (ids, keys of all bands) from the batches of ``df``.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.mapInArrow(lambda it: lean(_sent(sign(it), parts)), "part int, block binary").repartitionById(parts, F.col("part"))
    found = dealt.mapInArrow(lambda it: lean(_members(it)), "grp long, id long, first long")
    return materialize(found, name)


def slots(ids: np.ndarray, log: int) -> np.ndarray:
    """Places of the ids in a bitmap of 2 ** ``log`` bits."""
    return ids.view(np.uint64) * GOLDEN >> np.uint64(64 - log)


def bitmap(ids: DataFrame) -> tuple[int, np.ndarray]:
    """Logarithm of the size, and 64-bit words, of a bitmap of the ids; at most 2 ** BITMAP bits."""
    log = min(BITMAP, max(16, (BITS_PER_ID * ids.count()).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = slots(b.column(0).to_numpy(), log)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["w", "b"])

    got = ids.mapInArrow(words, "w int, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most 2 ** (BITMAP - 6) rows
    out = np.zeros(1 << log - 6, np.uint64)
    out[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return log, out


def among(ids: np.ndarray, held: tuple[int, np.ndarray]) -> np.ndarray:
    """Whether the bitmap has each id (or one in the same place)."""
    at = slots(ids, held[0])
    return (held[1][(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def one_each(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, line, size) once for each wanted id of (id, line) rows."""
    return texts.join(wanted, "id", "left_semi").groupBy("id").agg(F.min("line").alias("line")).withColumn("size", F.octet_length("line"))


def _rows(b: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch as Python values, a few at a time."""
    for k in range(0, b.num_rows, 256):
        yield from zip(*(c.to_pylist() for c in b.slice(k, 256).columns), strict=True)


def _verify(batches: Iterator[pa.RecordBatch], similarity: float, codes: Codes) -> Iterator[pa.RecordBatch]:
    """Links among pairs (a, b, text of a, text of b)."""

    def run() -> list[bool]:
        texts = {i: t for x, y, t, u in rows for i, t in ((x, t), (y, u))}
        sets = dict(zip(texts, (frozenset(c.tolist()) for c in codes(list(texts.values()))), strict=True))
        return [jaccard(sets[r[0]], sets[r[1]]) >= similarity for r in rows]

    for b in batches:
        hit: list[bool] = []
        rows, size = [], 0
        for r in _rows(b):
            rows.append(r)
            size += len(r[2]) + len(r[3])
            if size >= CODED:
                hit += run()
                rows, size = [], 0
        if rows:
            hit += run()
        yield pa.RecordBatch.from_arrays([b.column(j).filter(pa.array(hit, pa.bool_())) for j in range(2)], ["a", "b"])


def overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets numbered ``a`` with other ones numbered ``b``; members are distinct."""
    out = np.zeros((len(a), len(b)), np.float32)
    code, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    o = np.argsort(code, kind="stable")
    code, row = code[o], row[o]
    start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    n = np.diff(np.r_[start, len(code)])
    shared = np.repeat(n > 1, n)  # a code of one set only is in no intersection
    row, col = row[shared], np.repeat(np.arange((n > 1).sum()), n[n > 1])
    for k in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        s, e = np.searchsorted(col, [k, k + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, int(col[-1]) + 1 - k)), np.float32)
        m[row[s:e], col[s:e] - k] = 1
        out += m[a] @ m[b].T
    return out


def _compare(batches: Iterator[pa.RecordBatch], similarity: float, codes: Codes) -> Iterator[pa.RecordBatch]:
    """Links between components within sorted groups (grp, i, j) of (asks, id, comp, line) rows."""

    def links() -> Iterator[tuple[int, int]]:
        texts = {r[1]: (r[3], r[2]) for r in rows}
        at = {k: i for i, k in enumerate(texts)}
        a, b = (np.array([at[r[1]] for r in rows if r[0] == asks], np.int64) for asks in (True, False))
        comp = np.array([c for _, c in texts.values()], np.int64)
        if not len(a) or not len(b) or (comp == comp[0]).all():
            return
        sets = [np.unique(c) for c in codes([t for t, _ in texts.values()])]
        n = np.array([len(s) for s in sets], np.float64)
        both = overlaps(sets, a, b).astype(np.float64)
        hit = both / (n[a][:, None] + n[b][None] - both) >= similarity
        hit &= comp[a][:, None] != comp[b][None]
        now = comp.copy()
        for x in np.flatnonzero(hit.any(axis=1)):
            near = b[hit[x]]
            near = near[now[near] != now[a[x]]]
            new, k = np.unique(now[near], return_index=True)
            for y in near[k]:  # one link joins a whole component
                yield int(comp[a[x]]), int(comp[y])
            now[np.isin(now, new)] = now[a[x]]

    rows: list[tuple] = []
    last = None
    for b in batches:
        found = []
        for grp, i, j, *r in _rows(b):
            if (grp, i, j) != last:
                found += links() if rows else []
                rows, last = [], (grp, i, j)
            rows.append(tuple(r))
        yield _pairs(found)
    yield _pairs(list(links()) if rows else [])


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[j] for p in found], pa.int64()) for j in range(2)], ["a", "b"])


def linked(members: DataFrame, texts: DataFrame, similarity: float, codes: Codes) -> DataFrame:
    """Components (id, component_id) of the verified links among ``members`` (of ``candidates``).

    ``texts`` are (id, line, size), ``codes`` gives the codes that texts are compared by.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = members.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    pairs = pairs.join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b").join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
    once = materialize(components(pairs.select("a", "b", "line_a", "line_b").mapInArrow(lambda it: lean(_verify(it, similarity, codes)), "a long, b long")), "once")

    named = members.where("grp IS NOT NULL").select("grp", "id").distinct()
    named = materialize(named.join(texts.select("id", "size"), "id").join(once, "id", "left").select("grp", "id", "size", F.coalesce("component_id", "id").alias("comp")), "named")
    open_ = named.groupBy("grp").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("n"), F.sum("size").alias("bytes")).where("x < y")
    open_ = open_.withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int")).select("grp", "blocks")
    rest = named.join(open_, "grp").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asks = rest.select("grp", F.col("mine").alias("i"), every.alias("j"), F.lit(True).alias("asks"), "id", "comp")
    told = rest.select("grp", every.alias("i"), F.col("mine").alias("j"), F.lit(False).alias("asks"), "id", "comp")
    dealt = asks.unionByName(told).where("i <= j").join(texts.select("id", "line"), "id").select("grp", "i", "j", "asks", "id", "comp", "line")
    dealt = dealt.repartition(n, "grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    more = components(dealt.mapInArrow(lambda it: lean(_compare(it, similarity, codes)), "a long, b long")).select(F.col("id").alias("comp"), F.col("component_id").alias("over"))
    joined = once.select("id", F.col("component_id").alias("comp")).join(more, "comp", "left").select("id", F.coalesce("over", "comp").alias("component_id"))
    alone = more.join(once.select(F.col("id").alias("comp")), "comp", "left_anti").select(F.col("comp").alias("id"), F.col("over").alias("component_id"))
    out = materialize(joined.unionByName(alone), "joined")
    discard(once)
    discard(named)
    return out
