"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a perfect covering code: the (31, 26) Hamming code,
whose balls of radius 1 fill the space. A 64-bit fingerprint is cut into two
segments of 31 bits (two bits are left to the exact comparison). If two
fingerprints differ in at most 4 bits, they differ in at most 2 bits of the
first segment or in at most 1 bit of the second. So with x's nearest anchor a
(distance at most 1), y lies within 1 + 2 of a in the first segment, or within
1 + 1 in the second: every fingerprint is replicated to each anchor within
covering radius plus threshold (156 and 16 anchors), compared there with the
fingerprints whose nearest anchor it is, and no link is lost.

Equal fingerprints are one node. At an anchor, members already known to be
connected are not compared again, so a dense group costs about its size and
leaves a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import discard, lean, materialize, row_key
from prismset.llm.components import UnionFind, components
from prismset.llm.minhash import among, band_keys, bitmap, candidates, linked, one_each
from prismset.session import table

#: Length of a segment, and bits by which the two segments are shifted.
BITS = 31
SHIFTS = (0, 31)
#: Allowed differing bits within the first and the second segment; with 4 over
#: both, one of the two bounds always holds (2 + 1 + 1 = 4).
WITHIN = (2, 1)
MAX_BITS = sum(WITHIN) + 1
MASK = (1 << BITS) - 1
#: Shingle bytes gathered before their hashes are folded into bit counts.
FOLD = 1 << 16


def fingerprint(text: bytes, words: int, seed: int = 42) -> int:
    """SimHash of ASCII-lower-cased word shingles, as an unsigned 64-bit integer."""
    parts = text.lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    buf, ends, at = b" ".join(parts), [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    n = max(1, len(parts) - words + 1)
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    stops = ends[words - 1 :] if len(parts) >= words else ends[-1:]
    ones = np.zeros(64, np.int64)
    for k in range(0, n, FOLD):
        h = np.array([digest(buf[a:b], seed) for a, b in zip(starts[k : k + FOLD], stops[k : k + FOLD], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = np.fromiter((fingerprint(t.as_py() or b"", words, seed) for t in b.column(1)), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])


def hamming_masks(within: int) -> list[list[int]]:
    """For each syndrome, what to XOR to a word to get all code words near it.

    Position p (1 to 31) of the code is bit p - 1; the syndrome is the XOR of the
    positions of the set bits, so flipping the bit at the syndrome gives the
    nearest code word. Others within ``1 + within`` differ from that one by a
    code word of weight 3 or 4 (the least weights of the code).
    """
    near = [0]
    near += [(1 << a - 1) | (1 << b - 1) | (1 << (a ^ b) - 1) for a in range(1, 32) for b in range(a + 1, 32) if a ^ b > b]
    near += [(1 << a - 1) | (1 << b - 1) | (1 << c - 1) | (1 << (a ^ b ^ c) - 1) for a in range(1, 32) for b in range(a + 1, 32) for c in range(b + 1, 32) if a ^ b ^ c > c]
    flipped = [[w ^ (1 << s - 1 if s else 0) for w in near] for s in range(32)]
    return [[m for m in ms if m.bit_count() <= 1 + within] for ms in flipped]


def _syndrome(seg: Column) -> Column:
    """Syndrome of a 31-bit word: parities over the positions with each bit set."""
    out = F.lit(0)
    for j in range(5):
        over = sum(1 << p - 1 for p in range(1, 32) if p >> j & 1)
        out = out + (F.bit_count(seg.bitwiseAND(F.lit(over))) % 2) * (1 << j)
    return out.cast("int")


def replicate(fps: DataFrame) -> DataFrame:
    """(anchor, fp) for every anchor within covering radius plus threshold."""
    spark = fps.sparkSession
    out = None
    for k, (shift, within) in enumerate(zip(SHIFTS, WITHIN, strict=True)):
        masks = F.broadcast(spark.createDataFrame([(s, m) for s, m in enumerate(hamming_masks(within))], "s int, masks array<long>"))  # 32 rows
        seg = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(MASK))
        one = fps.select("fp", seg.alias("seg")).withColumn("s", _syndrome(F.col("seg"))).join(masks, "s")
        one = one.select("fp", "seg", F.explode("masks").alias("mask")).select(F.col("seg").bitwiseXOR(F.col("mask")).bitwiseOR(F.lit(k << BITS)).alias("anchor"), "fp")
        out = one if out is None else out.unionByName(one)
    return out


def _compare(anchor: int, fps: np.ndarray, uf: UnionFind, max_bits: int) -> None:
    """Link each fingerprint at home here with every near one, as a forest."""
    shift = SHIFTS[anchor >> BITS]
    word = np.uint64(anchor & MASK)
    home = np.bitwise_count(((fps >> np.uint64(shift)) & np.uint64(MASK)) ^ word) <= 1
    comp = np.arange(len(fps))
    for i in np.flatnonzero(home):
        rest = np.flatnonzero(comp != comp[i])
        if not len(rest):
            break
        hit = rest[np.bitwise_count(fps[rest] ^ fps[i]) <= max_bits]
        if len(hit):
            joined = np.unique(comp[hit])
            comp[np.isin(comp, joined)] = comp[i]
            for j in hit:
                uf.union(int(fps[i]), int(fps[j]))


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Spanning forests of the links at each anchor of a partition sorted by anchor."""

    def flush(uf: UnionFind) -> pa.RecordBatch:
        nodes, roots = uf.forest()
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, roots)], ["a", "b"])

    def run(anchors: np.ndarray, fps: np.ndarray) -> None:
        cut = np.flatnonzero(np.diff(anchors)) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, len(anchors)]
        shift = np.where(anchors >> BITS, SHIFTS[1], SHIFTS[0]).astype(np.uint64)
        home = np.bitwise_count(((fps >> shift) & np.uint64(MASK)) ^ (anchors & MASK).astype(np.uint64)) <= 1
        homes = np.add.reduceat(home, starts, dtype=np.int64) if len(anchors) else np.zeros(0, int)
        for k in np.flatnonzero((homes > 0) & (ends - starts > 1)):
            s, e = starts[k], ends[k]
            _compare(int(anchors[s]), fps[s:e], uf, max_bits)

    uf = UnionFind()
    held_a, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        a, f = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
        if not len(a):
            continue
        parts.append((a, f))
        if parts[0][0][0] == a[-1]:  # one anchor so far
            continue
        a, f = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        k = np.searchsorted(a, a[-1])
        run(a[:k], f[:k])
        parts = [(a[k:], f[k:])]
        if len(uf.up) > 500_000:
            yield flush(uf)
            uf = UnionFind()
    if parts:
        held_a, held_f = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        run(held_a, held_f)
    yield flush(uf)


def simhash_near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, max_bits: int = MAX_BITS, seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept.

    Texts are lower-cased over A-Z and cut into words at ``[\\x20\\x09-\\x0D]``;
    a shingle is ``words`` words joined by a space, repeats included. A text with
    fewer words has one shingle, one without words (null too) the fingerprint
    zero, which links like any other. Fingerprints link at ``max_bits`` (at most
    4) differing bits; ``component_id`` is the smallest doc_id reachable. A row
    with a null id keeps a null component unless others share its fingerprint.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = materialize(
        df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(lambda it: lean(_fingerprints(it, words, seed)), "doc_id long, fp long"),
        "simhash",
    )
    nodes = docs.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    spread = docs.select("fp").distinct().repartition(n)  # many tasks to replicate in
    near = replicate(spread).repartition(n, "anchor").sortWithinPartitions("anchor")  # _links takes each anchor's rows from one run
    links = near.mapInArrow(lambda it: lean(_links(it, max_bits)), "a long, b long")
    joined = components(links)  # over fingerprints; then to the smallest document of each
    classes = nodes.join(joined, nodes.fp == joined.id, "left").select("fp", "rep", F.coalesce("component_id", "fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = classes.join(least, "root").select("fp", "component_id")
    return docs.join(classes, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


#: Bands of a near-copy signature and permutations of a band: a pair at a
#: similarity of 0.8 is missed once in 1,400, one at 0.85 once in 170,000.
BANDS = 24
ROWS = 6
#: Bytes of text signed at once.
SIGNED = 1 << 19


def shingle_codes(texts: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``word_shingles`` of all texts, repeats included; first of each text."""
    digest = xxhash.xxh3_64_intdigest
    parts = [t.lower().split() for t in texts]
    hashes = [np.fromiter((digest(w) for w in p), np.uint64, len(p)) for p in parts]
    hashes = [np.r_[h, np.zeros(words - len(h), np.uint64)] if len(h) < words else h for h in hashes]
    buf = np.concatenate(hashes)
    n = np.array([len(h) for h in hashes], np.int64)
    code = np.zeros(len(buf) - words + 1, np.uint64)
    for k in range(words):
        code = (code ^ buf[k : len(buf) - words + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    keep = np.ones(len(code), bool)  # shingles that run into the next text
    ends = np.cumsum(n)[:-1]
    for k in range(1, words):
        keep[ends - k] = False
    return code[keep], np.r_[0, np.cumsum(n - words + 1)[:-1]]


def code_sets(texts: list[bytes]) -> list[np.ndarray]:
    """``shingle_codes`` of each text."""
    code, first = shingle_codes(texts)
    return np.split(code, first[1:])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, band keys) of all texts, some SIGNED bytes at a time."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ids.append(i)
            texts.append(t.as_py() or b"")
            size += len(texts[-1])
            if size >= SIGNED:
                yield np.array(ids, np.int64), band_keys(*shingle_codes(texts), BANDS, ROWS)
                ids, texts, size = [], [], 0
    if ids:
        yield np.array(ids, np.int64), band_keys(*shingle_codes(texts), BANDS, ROWS)


def near_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """(key, keep_key, keep_id) of the rows that are linked with others, by ``row_key``.

    Candidates share one of BANDS bands of a MinHash signature of their five-word
    shingles; links are the candidates whose shingle sets have a Jaccard similarity
    of ``similarity`` or more. Every two rows of a band are compared unless links
    join them already. Of each component the row with the smallest id leads (null
    last, then the smallest key). Texts without words are copies of each other.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), row_key(df).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("line"))
    members = candidates(docs.select("id", "line"), _signed, "near-members")
    wanted = members.select("id").distinct()
    held = df.sparkSession.sparkContext.broadcast(bitmap(wanted))  # of a bounded size

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(among(b.column(1).to_numpy(), held.value)))

    some = materialize(docs.mapInArrow(lambda it: lean(sift(it)), "doc_id long, id long, line binary").join(wanted, "id", "left_semi"), "near-rows")
    texts = materialize(one_each(some.select("id", "line"), wanted), "near-texts")
    joined = linked(members, texts, similarity, code_sets)
    discard(members)
    discard(texts)
    return _led(some.select("id", "doc_id").distinct().join(joined, "id"))


def _led(rows: DataFrame) -> DataFrame:
    """(key, keep_key, keep_id) of rows (id, doc_id, component_id): of each component the smallest doc_id leads."""
    lead = rows.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")).alias("lead"))
    return rows.join(lead, "component_id").select(F.col("id").alias("key"), F.col("lead.id").alias("keep_key"), F.col("lead.doc_id").alias("keep_id"))


def near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row per input row: doc_id, component_id, kept, by the links of ``near_rows``.

    ``component_id`` is the smallest id of the component; a row that is linked with
    no other is its own, kept component, with a null id too. Rows of one id with
    different texts are decided on apart, rows that agree in all columns alike. An
    empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), row_key(df).alias("key"))
    found = rows.join(near_rows(df, id_col, text_col, similarity), "key", "left")
    alone = F.col("keep_key").isNull()
    return found.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("component_id"), (alone | (F.col("key") == F.col("keep_key"))).alias("kept"))


def all_near_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """``near_rows`` by both kinds of links: those of ``simhash_near_dedup`` and those of five-word similarity.

    SimHash links (four words, MAX_BITS) count as the operator gives them; MinHash
    bands add the similar texts whose fingerprints lie further apart.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), row_key(df).alias("id"), F.col(text_col).alias("text"))
    hashed = simhash_near_dedup(docs.select("id", "text"), "id", "text", words=4).where("not kept").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    similar = near_rows(df, id_col, text_col, similarity).where("key <> keep_key").select(F.col("key").alias("a"), F.col("keep_key").alias("b"))
    joined = components(hashed.unionByName(similar))
    return _led(docs.select("id", "doc_id").distinct().join(joined, "id"))


def drop_near(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """``df`` with one row of each component of ``all_near_rows``; rows that agree in all columns stay or go together."""
    gone = all_near_rows(df, id_col, text_col, similarity).where("key <> keep_key").select(F.col("key").alias("_gone")).distinct()
    return df.join(gone, row_key(df) == F.col("_gone"), "left_anti")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all ``documents``: four-word shingles, four bits."""
    return simhash_near_dedup(table(spark, sf_dir, "documents"), words=4, max_bits=4)
