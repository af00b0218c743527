"""Exact deduplication by Grace hashing.

Map side: every task keeps an open-addressing table of the contents it meets and
turns copies into counts, so a text that a third of all rows share leaves each
task once. What is left is dealt out by a hash of the content; each reduce task
then runs the Grace scheme: contents go into a table until its budget is used
up, from there on to spill files chosen by the next bits of the hash, and each
file is treated the same way one level deeper until it fits. Tables compare the
complete content, never only its hash. Rows find their class over the number of
their map-side table entry, a key that no more rows share than one task read.

Spill files are unnamed scratch files of one task attempt (gone when closed), so
a lost executor only means that its tasks are run again.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import SPACE, lean, materialize, row_key
from prismset.session import table

#: Bytes of content that one table holds before it is emptied or spilled.
TABLE_BYTES = 32 << 20
#: Spill files of one level; each level uses the next four bits of the hash.
FAN_OUT = 16
MAX_LEVEL = 12


#: What copies are ordered by: minus the code points of the original text, whether
#: the id is null, the id (0 if null), the row's key.
Rank = tuple[int, bool, int, int]


class Entry:
    """A distinct content with its copies so far."""

    __slots__ = ("best", "content", "count", "hash", "number", "parts")

    def __init__(self, hash_: int, content: bytes, number: int) -> None:
        self.hash, self.content, self.number = hash_, content, number
        self.count = 0
        self.best: Rank | None = None
        self.parts: list[int] = []

    def add(self, count: int, best: Rank) -> None:
        """Count copies; the first by rank leads."""
        self.count += count
        if self.best is None or best < self.best:
            self.best = best


class OpenTable:
    """Open addressing with linear probing; equality compares whole contents."""

    def __init__(self) -> None:
        self.slots: list[Entry | None] = [None] * 1024
        self.used = 0
        self.bytes = 0

    def _slot(self, hash_: int, content: bytes) -> int:
        mask = len(self.slots) - 1
        i = hash_ & mask
        while (e := self.slots[i]) is not None and not (e.hash == hash_ and e.content == content):
            i = (i + 1) & mask
        return i

    def get(self, hash_: int, content: bytes) -> Entry | None:
        return self.slots[self._slot(hash_, content)]

    def put(self, e: Entry) -> None:
        if 3 * (self.used + 1) > 2 * len(self.slots):
            old = self.entries()
            self.slots = [None] * (2 * len(self.slots))
            for x in old:
                self.slots[self._slot(x.hash, x.content)] = x
        self.slots[self._slot(e.hash, e.content)] = e
        self.used += 1
        self.bytes += len(e.content) + 200

    def entries(self) -> list[Entry]:
        return [e for e in self.slots if e is not None]


def _local(batches: Iterator[pa.RecordBatch], table_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, key, entry) and the task's distinct contents (entry, ..., packed)."""
    pack = zstandard.ZstdCompressor(level=1).compress
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
    held = OpenTable()

    def out(entries: list[Entry]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None if e.best[1] else e.best[2] for e in entries], pa.int64()),
                pa.array([e.best[3] for e in entries], pa.int64()),
                pa.array([e.number for e in entries], pa.int64()),
                pa.array([e.count for e in entries], pa.int64()),
                pa.array([-e.best[0] for e in entries], pa.int64()),
                pa.array([e.hash - (1 << 63) for e in entries], pa.int64()),
                pa.array([pack(e.content) for e in entries], pa.binary()),
            ],
            names,
        )

    names = ["doc_id", "key", "entry", "count", "best_n", "hash", "packed"]
    for b in batches:
        ids, numbers = b.column(0).to_pylist(), []
        for id_, text, n, key in zip(ids, b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            content = (text.as_py() or b"").translate(None, SPACE)
            h = xxhash.xxh64_intdigest(content, 0)
            e = held.get(h, content)
            if e is None:
                e = Entry(h, content, number)
                number += 1
                held.put(e)
            e.add(1, (-(n or 0), id_ is None, id_ or 0, key))
            numbers.append(e.number)
            if held.bytes > table_bytes:  # repeated contents stay, the others leave
                once = [x for x in held.entries() if x.count == 1]
                again = [x for x in held.entries() if x.count > 1]
                if sum(len(x.content) for x in again) > table_bytes // 2:
                    once, again = once + again, []
                held = OpenTable()
                for x in again:
                    held.put(x)
                for k in range(0, len(once), 1000):
                    yield out(once[k : k + 1000])
        none = pa.nulls(len(ids), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), b.column(3), pa.array(numbers, pa.int64()), none, none, none, pa.nulls(len(ids), pa.binary())], names)
    rest = held.entries()
    for k in range(0, len(rest), 1000):
        yield out(rest[k : k + 1000])


def grace(records: Iterable[tuple], table_bytes: int, level: int = 0) -> Iterator[Entry]:
    """Distinct contents of (hash, content, count, rank of the best copy, [parts]) records.

    Contents that are in the table take in further copies at once; others go to
    the spill file of their hash bits when the table is full.
    """
    held, files = OpenTable(), {}
    for rec in records:
        hash_, content, count, best, parts = rec
        e = held.get(hash_, content)
        if e is None and (held.bytes + len(content) <= table_bytes or not held.used or level >= MAX_LEVEL):
            e = Entry(hash_, content, 0)
            held.put(e)
        if e is not None:
            e.add(count, best)
            e.parts += parts
        else:
            k = hash_ >> (60 - 4 * level) & (FAN_OUT - 1)
            if k not in files:
                files[k] = tempfile.TemporaryFile()
            pickle.dump(rec, files[k], protocol=5)
    yield from held.entries()
    del held
    for f in files.values():
        f.seek(0)
        yield from grace(_reread(f), table_bytes, level + 1)
        f.close()


def _reread(f) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def _classes(batches: Iterator[pa.RecordBatch], table_bytes: int) -> Iterator[pa.RecordBatch]:
    """(entry, keep_id, keep_key, group_size, text_sha256) for every map-side entry of a partition."""
    open_ = zstandard.ZstdDecompressor().decompress

    def records() -> Iterator[tuple]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                for id_, key, entry, count, n, h, packed in zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True):
                    yield h + (1 << 63), open_(packed), count, (-n, id_ is None, id_ or 0, key), [entry]

    rows: list[tuple] = []
    for e in grace(records(), table_bytes):
        sha = hashlib.sha256(e.content).hexdigest()
        rows += [(p, None if e.best[1] else e.best[2], e.best[3], e.count, sha) for p in e.parts]
        if len(rows) >= 5000:
            yield _table(rows)
            rows = []
    yield _table(rows)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.string()), strict=True)], ["entry", "keep_id", "keep_key", "group_size", "text_sha256"])


def exact_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, key, keep_id, keep_key, group_size, text_sha256) of every row; ``key`` is its ``row_key``.

    The rows that lead their groups are as in ``exact_dedup``; of rows with one id
    the one with the smallest key leads.
    """
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.coalesce(F.length(F.col(text_col)), F.lit(0)).cast("long").alias("n"), row_key(df).alias("key"))
    local = materialize(
        src.mapInArrow(lambda it: lean(_local(it, table_bytes)), "doc_id long, key long, entry long, count long, best_n long, hash long, packed binary"),
        "grace",
    )
    dealt = local.where("count is not null").repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "hash").select("doc_id", "key", "entry", "count", "best_n", "hash", "packed")
    classes = dealt.mapInArrow(lambda it: lean(_classes(it, table_bytes)), "entry long, keep_id long, keep_key long, group_size long, text_sha256 string")
    rows = local.where("count is null").select("doc_id", "key", "entry")
    return rows.join(classes, "entry").drop("entry")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Two texts are equal when they are identical after every character of
    ``[\\x20\\x09-\\x0D]`` is deleted; a null text counts as empty, and all empty
    texts are one group. Of a group the row with the most code points in the
    original text stays, of those the smallest id (a null id comes last). Rows
    repeated under one id count as copies and are kept or dropped together. An
    empty table gives an empty result; other columns of ``df`` are not touched.
    """
    rows = exact_rows(df, id_col, text_col, table_bytes)
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the one row of each group of equal texts that leads it.

    Rows are told apart by their whole content, not by their id: of a null or
    repeated id with different texts no unique text is lost, and of rows that
    agree in all columns one stays.
    """
    gone = exact_rows(df, id_col, text_col).where("key <> keep_key").select(F.col("key").alias("_gone")).distinct()
    rows = df.select(F.struct("*").alias("row"), row_key(df).alias("key"))
    return rows.join(gone, F.col("key") == F.col("_gone"), "left_anti").dropDuplicates(["key"]).select("row.*")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact deduplication of all ``documents``."""
    return exact_dedup(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
