"""Fuzzy line deduplication by MinHash.

Lines are compared by the sets of their character shingles: MinHash signatures
with high-recall bands, exact Jaccard similarity of the candidates, components by
distributed union-find (see ``minhash``). Equal lines are one node, named by the
XXH64 of the normalised line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import discard, lean, materialize
from prismset.llm.minhash import GOLDEN, among, band_keys, bitmap, candidates, linked, one_each
from prismset.session import table

SHINGLE = 6
SIMILARITY = 0.8
#: Bands of a signature and hashes of a band: a pair at 0.8 is missed once in 400,
#: at any length of the lines.
BANDS = 15
ROWS = 5
#: Line ids that a task remembers so as not to hand on a line twice, characters
#: signed at once.
SEEN = 400_000
CHARS = 1 << 18
#: White space that a run of may be more than the one space between words.
ODD = (b"  ", b"\t", b"\r", b"\x0b", b"\x0c")


def normal_lines(text: bytes | None) -> list[bytes]:
    """Lines of a text, ASCII-lower-cased, runs of white space as one space."""
    if text is None:
        return []
    text = text.lower()
    if any(x in text for x in ODD):
        return [b" ".join(x.split()) for x in text.split(b"\n")]
    return [x.strip(b" ") for x in text.split(b"\n")]


def line_id(line: bytes) -> int:
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all shingles of all lines (a shorter line is one shingle); first of each line.

    A shingle of characters below U+0400 is its code, ten bits for each; others
    are told apart by a 63-bit hash.
    """
    texts = [x.decode("utf-8", "replace") for x in lines]
    texts = [t if len(t) >= SHINGLE else t.ljust(SHINGLE, "\0") for t in texts]
    buf = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = np.array([len(t) for t in texts], np.int64)
    m = len(buf) - SHINGLE + 1
    two = buf[:-1] << np.uint64(10) | buf[1:]
    code = two[:m] << np.uint64(40) | two[2 : m + 2] << np.uint64(20) | two[4 : m + 4]
    wide = buf >> np.uint64(10) != 0
    if wide.any():
        some, h = np.zeros(m, bool), np.zeros(m, np.uint64)
        for k in range(SHINGLE):
            some |= wide[k : m + k]
            h = (h ^ buf[k : m + k]) * GOLDEN
            h ^= h >> np.uint64(29)
        code[some] = h[some] | np.uint64(1 << 63)
    keep = np.ones(m, bool)
    ends = np.cumsum(n)[:-1]
    for k in range(1, SHINGLE):
        keep[ends - k] = False
    return code[keep], np.r_[0, np.cumsum(n - SHINGLE + 1)[:-1]]


def code_sets(lines: list[bytes]) -> list[np.ndarray]:
    """Shingle codes of each line."""
    code, first = shingles(lines)
    return np.split(code, first[1:])


def bands(lines: list[bytes]) -> np.ndarray:
    """(line, band) keys of the whole lines."""
    code, first = shingles(lines)
    code = (code ^ code >> np.uint64(31)) * GOLDEN
    code ^= code >> np.uint64(29)
    return band_keys(code * np.uint64(0xBF58476D1CE4E5B9), first, BANDS, ROWS)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, band keys) of lines that this task hasn't signed lately, some CHARS at a time."""
    seen: set[int] = set()
    ids, lines, size = [], [], 0
    for b in batches:
        for t in b.column(0):
            for x in normal_lines(t.as_py()):
                if x and (k := line_id(x)) not in seen:
                    seen.add(k)
                    ids.append(k)
                    lines.append(x)
                    size += len(x)
                    if size >= CHARS:
                        yield np.array(ids, np.int64), bands(lines)
                        ids, lines, size = [], [], 0
        if len(seen) > SEEN:
            seen = set()
    if ids:
        yield np.array(ids, np.int64), bands(lines)


def _occurrences(batches: Iterator[pa.RecordBatch], held: tuple[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(doc_id, line_no, id, line); the line itself only where the bitmap has it, once in a while."""
    seen: set[int] = set()
    for b in batches:
        ids, nos, keys, texts = [], [], [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            lines = normal_lines(t.as_py())
            ids += [i] * len(lines)
            nos += range(len(lines))
            keys += [line_id(x) if x else None for x in lines]
            texts += lines
        mine = among(np.array([k or 0 for k in keys], np.int64), held)
        for k in range(len(texts)):
            if mine[k] and keys[k] is not None and keys[k] not in seen:
                seen.add(keys[k])
            else:
                texts[k] = None
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array(keys, pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "line_no", "id", "line"])
        if len(seen) > SEEN:
            seen = set()


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per line of the input: doc_id, line_no, keep_doc_id, keep_line_no, group_size, kept.

    Lines are cut at line feeds and compared lower-cased (A-Z) with runs of white
    space as one space. Of the lines that are equal or linked, directly or over
    others, at a Jaccard similarity of ``similarity`` of their 6-character
    shingles, the first by (doc_id, line_no) stays. Blank lines are never joined:
    each stays. A null text has no line, an empty one has one blank line; a null
    id sorts first. Rows repeated under one id hold their lines together. An
    empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    members = candidates(docs.select("text"), _signed, "members")
    wanted = members.select("id").distinct()
    held = df.sparkSession.sparkContext.broadcast(bitmap(wanted))  # of a bounded size
    lines = materialize(docs.mapInArrow(lambda it: lean(_occurrences(it, held.value)), "doc_id long, line_no int, id long, line binary"), "lines")
    texts = materialize(one_each(lines.where("line IS NOT NULL").select("id", "line"), wanted), "texts")
    joined = linked(members, texts, similarity, code_sets)
    discard(members)
    discard(texts)

    # lines that occur once and are linked with no other are left out of the groups
    place = F.struct("doc_id", "line_no")
    first = lines.where("id IS NOT NULL").groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = first.join(joined, "id", "left").where("n > 1 OR component_id IS NOT NULL").select("id", "first", "n", F.coalesce("component_id", "id").alias("root"))
    groups = first.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("group_size"))
    by_id = first.select("id", "root").join(groups, "root").select("id", "keep", "group_size")
    out = lines.where("id IS NOT NULL").select("doc_id", "line_no", "id").join(by_id, "id", "left").select("doc_id", "line_no", F.coalesce("keep", place).alias("keep"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))
    out = out.unionByName(lines.where("id IS NULL").select("doc_id", "line_no", place.alias("keep"), F.lit(1).cast("long").alias("group_size")))
    return out.select(
        "doc_id",
        "line_no",
        F.col("keep.doc_id").alias("keep_doc_id"),
        F.col("keep.line_no").alias("keep_line_no"),
        "group_size",
        place.eqNullSafe(F.col("keep")).alias("kept"),
    )


def drop_lines(df: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the lines that ``decisions`` (of ``line_dedup``) drops taken out of the text."""
    gone = decisions.where("not kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone"))  # lines of one document
    keep = F.filter(F.split(F.col(text_col), "\n", -1), lambda _, k: ~F.array_contains(F.col("_gone"), k))
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(keep, "\n"))
    return df.join(gone.withColumnRenamed("doc_id", "_gone_id"), F.col(id_col) == F.col("_gone_id"), "left").withColumn(text_col, text).select(*df.columns)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy deduplication of all lines of ``documents``."""
    return line_dedup(table(spark, sf_dir, "documents"))
