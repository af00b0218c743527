"""Exact and near deduplication of records with small keys (files, hashes)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exact_groups(df: DataFrame, key: Column, order: str) -> DataFrame:
    """(representative, copies, member): a row for each member of a key that several rows share.

    ``representative`` is the group's lowest ``order``. No group is gathered, so a
    key that very many rows share costs no more than others.
    """
    keyed = df.select(key.alias("_k"), F.col(order).alias("member"))
    g = keyed.groupBy("_k").agg(F.min("member").alias("representative"), F.count("*").alias("copies")).where("copies > 1")
    return keyed.join(g, keyed._k.eqNullSafe(g._k)).select("representative", "copies", "member")


def first_of(df: DataFrame, key: Column, order: str) -> DataFrame:
    """``df`` with ``representative``, the lowest ``order`` of the row's key.

    A grouping with map-side sums and a join, not a window, so a key that very
    many rows share is no single task's sort. The join is a sorted one: there may
    be as many keys as rows, and a size estimated from compressed files is no bound
    on what a broadcast of them would take of the driver's memory.
    """
    keyed = df.withColumn("_key", key)
    least = keyed.groupBy("_key").agg(F.min(order).alias("representative")).hint("merge")
    return keyed.join(least, keyed._key.eqNullSafe(least._key)).drop("_key")


def distance(a: str, b: str) -> Column:
    """Differing bits of two hashes held as 32-bit halves ``lo`` and ``hi``."""
    return F.bit_count(F.col(f"{a}.lo").bitwiseXOR(F.col(f"{b}.lo"))) + F.bit_count(F.col(f"{a}.hi").bitwiseXOR(F.col(f"{b}.hi")))


#: Rows of a block when all pairs are compared, at most and at least; hashes of it
#: that are compared with one hash at once.
BLOCK = 1 << 17
LEAST_BLOCK = 1 << 10
TILE = 1 << 14


def _probes(t: int) -> tuple[Column, Column]:
    """(band, value) arrays of a hash ``whole``: as it is, and with up to one bit of a band flipped.

    With t // 2 + 1 bands, two hashes at most ``t`` bits apart differ by one bit at
    most in one of them.
    """
    n = t // 2 + 1
    cuts = [round(k * 64 / n) for k in range(n + 1)]
    spans = list(zip(cuts, cuts[1:], strict=False))
    value = lambda lo, hi: F.shiftrightunsigned(F.shiftleft("whole", 64 - hi), 64 - hi + lo)
    own = F.array(*(F.struct(F.lit(k).alias("band"), value(lo, hi).alias("value")) for k, (lo, hi) in enumerate(spans)))
    flips = lambda k, lo, hi: F.transform(F.array(*(F.lit(m).cast("long") for m in [0, *(1 << j if j < 63 else -1 << 63 for j in range(hi - lo))])), lambda m: F.struct(F.lit(k).alias("band"), value(lo, hi).bitwiseXOR(m).alias("value")))
    return own, F.concat(*(flips(k, lo, hi) for k, (lo, hi) in enumerate(spans)))


def _within(a: np.ndarray, b: np.ndarray, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``a`` and ``b`` of hashes at most ``t`` bits apart, a tile of ``b`` at a time; of ``a`` with itself each pair once."""
    for s in range(0, len(b), TILE):
        tile = b[s : s + TILE]
        bits, n = np.empty_like(tile), np.empty(len(tile), np.uint8)
        at, other = [], []
        for r in range(min(len(a), s + len(tile)) if a is b else len(a)):
            k = max(0, r + 1 - s) if a is b else 0
            np.bitwise_xor(tile[k:], a[r], out=bits[k:])
            np.bitwise_count(bits[k:], out=n[k:])
            hit = np.flatnonzero(n[k:] <= t)
            if len(hit):
                at.append(np.full(len(hit), r))
                other.append(hit + (k + s))
        if at:
            yield np.concatenate(at), np.concatenate(other)


def _block_pairs(batches: Iterator[pa.RecordBatch], t: int) -> Iterator[pa.RecordBatch]:
    """(i, j, d) of the pairs of blocks (k, m) in sorted rows (k, m, mine, i, whole)."""

    def found() -> Iterator[pa.RecordBatch]:
        mine, i, h = (np.concatenate(x) for x in zip(*held, strict=True))
        (k, m), h = last, h.view(np.uint64)
        ids = [i[mine == x] for x in (k, m)]
        a = h[mine == k]
        b = a if k == m else h[mine == m]
        for x, y in _within(a, b, t):
            d = np.bitwise_count(a[x] ^ b[y]).astype(np.int32)
            x, y = ids[0][x], ids[1][y]
            one = x != y
            yield pa.RecordBatch.from_arrays([pa.array(c[one]) for c in (np.minimum(x, y), np.maximum(x, y), d)], ["i", "j", "d"])

    held: list[tuple[np.ndarray, ...]] = []
    last = None
    for batch in batches:
        k, m, *rest = (c.to_numpy() for c in batch.columns)
        cut = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (m[1:] != m[:-1])]) if len(k) else []
        for s, e in zip(cut, [*cut[1:], len(k)], strict=True):
            if (k[s], m[s]) != last:
                if held:
                    yield from found()
                held, last = [], (k[s], m[s])
            held.append(tuple(c[s:e] for c in rest))
    if held:
        yield from found()


def near_pairs(hashes: DataFrame, t: int) -> DataFrame:
    """(i, j, d) with i < j of 64-bit hashes (i, lo, hi) at most ``t`` bits apart.

    Up to 12 bits one side of an equi-join on (band, value) brings its bands, the
    other the same with up to one bit flipped. Beyond, bands would be too short to
    select anything, and the exact answer is a comparison of all pairs: rows are
    dealt into blocks, and each pair of blocks is compared in numpy, by one task.
    """
    whole = F.shiftleft("hi", 32).bitwiseOR(F.col("lo"))
    rows = hashes.select("i", "lo", "hi")
    if t <= 12:
        own, probes = _probes(t)
        rows = rows.withColumn("whole", whole)
        a = rows.select("i", "lo", "hi", F.explode(own).alias("at")).select("i", "lo", "hi", "at.band", "at.value").alias("a")
        b = rows.select("i", "lo", "hi", F.explode(probes).alias("at")).select("i", "lo", "hi", "at.band", "at.value").alias("b")
        on = (F.col("a.band") == F.col("b.band")) & (F.col("a.value") == F.col("b.value"))
        # sizes are estimated without the explosion, so that the planner would broadcast either side
        found = a.join(b.hint("merge"), on & (F.col("a.i") < F.col("b.i")) & (distance("a", "b") <= t))
        return found.select(F.col("a.i").alias("i"), F.col("b.i").alias("j"), distance("a", "b").cast("int").alias("d")).distinct()
    rows = _stored(rows.select(F.col("i").cast("long").alias("i"), whole.alias("whole")).where("i IS NOT NULL AND whole IS NOT NULL"))
    parts = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = rows.count()
    # blocks of BLOCK rows at most; smaller ones if that gives some four pairs of blocks to each partition
    n = max(-(-count // BLOCK), min(-(-count // LEAST_BLOCK), round((8 * parts) ** 0.5)), 1)
    every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("mine", F.pmod(F.xxhash64("i"), F.lit(n)).cast("int")).select("i", "whole", "mine", every.alias("other"))
    dealt = dealt.select(F.least("mine", "other").alias("k"), F.greatest("mine", "other").alias("m"), "mine", "i", "whole")
    # pairs of blocks by number, one after the other over the partitions
    place = F.expr(f"pmod(m * (m + 1) div 2 + k, {parts})").cast("int")
    dealt = dealt.repartitionById(parts, place).sortWithinPartitions("k", "m")
    return dealt.mapInArrow(lambda it: _block_pairs(it, t), "i long, j long, d int").distinct()


def _folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local session that names none gets a temporary one."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="prismset-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back; cuts the lineage."""
    path = f"{_folder(df.sparkSession)}/rounds-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _forget(df: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def leader_groups(pairs: DataFrame) -> DataFrame:
    """(leader, member) of greedy leader clustering over (i, j) pairs with i < j.

    In order of id, a row that no earlier leader has absorbed leads and absorbs
    its later neighbours; absorbed rows never lead, so this is not connected
    components. Rounds: undecided rows whose earlier neighbours are all decided
    lead, their undecided neighbours are absorbed; pairs of decided rows leave. A
    member's leader is its lowest adjacent leader.

    The joins are sorted ones: the sides grow with the pairs, and their files are
    too small for the planner's bound on broadcasts to hold the driver's memory.
    """
    pairs = _stored(pairs.select("i", "j"))
    open_, absorbed = pairs, None
    while not open_.isEmpty():
        first = open_.select("i").distinct().join(open_.select(F.col("j").alias("i")).distinct().hint("merge"), "i", "left_anti")
        hit = _stored(open_.join(first.hint("merge"), "i", "left_semi").select(F.col("j").alias("i")).distinct())
        done = first.unionByName(hit)
        left = _stored(open_.join(done.hint("merge"), "i", "left_anti").join(hit.select(F.col("i").alias("j")).hint("merge"), "j", "left_anti").select("i", "j"))
        absorbed = hit if absorbed is None else absorbed.unionByName(hit)
        if open_ is not pairs:
            _forget(open_)
        open_ = left
    led = pairs if absorbed is None else pairs.join(absorbed.hint("merge"), "i", "left_anti")
    return led.groupBy(F.col("j").alias("member")).agg(F.min("i").alias("leader")).select("leader", "member")


def near_leaders(hashes: DataFrame, t: int) -> DataFrame:
    """(leader, member) of the leader clustering of hashes (i, lo, hi) at most ``t`` bits apart.

    Rows of one hash have the same neighbours, so only the first of each takes
    part; the others follow it, or are absorbed by it if it leads.
    """
    first = _stored(hashes.groupBy("lo", "hi").agg(F.min("i").alias("i"), F.count("*").alias("n")))
    near = _stored(leader_groups(near_pairs(first.select("i", "lo", "hi"), t)))
    more = hashes.join(first.where("n > 1").select("lo", "hi", F.col("i").alias("rep")).hint("merge"), ["lo", "hi"]).where("i <> rep").select("rep", F.col("i").alias("member"))
    more = more.join(near.select("leader", F.col("member").alias("rep")).hint("merge"), "rep", "left").select(F.coalesce("leader", "rep").alias("leader"), "member")
    return near.unionByName(more)


def ordinal(df: DataFrame, prefix: str, order: str) -> DataFrame:
    """``df`` (one row a group) with names prefix1, prefix2, ... in order.

    Places come from two levels, rows within a range and the ranges before it, so
    no task sees all rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    dealt = _stored(df.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("_part", F.shiftright(at, 33)).withColumn("_at", at.bitwiseAND((1 << 33) - 1)))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return dealt.join(F.broadcast(sizes), "_part").withColumn("name", F.concat(F.lit(prefix), (F.col("_before") + F.col("_at") + 1).cast("string"))).drop("_part", "_at", "_before")
