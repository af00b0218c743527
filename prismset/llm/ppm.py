"""Language-model scoring by prediction by partial matching (PPM).

The model is a trie of byte contexts of order 0 to ``order`` over the words of
the training texts (ASCII-lower-cased, one space between words, one end mark).
A symbol is predicted in the longest context that has seen it; every longer one
charges an escape (method C: distinct symbols over occurrences plus distinct
symbols), and symbols of a context that was escaped from are excluded from the
shorter ones. In the end a uniform choice among unseen bytes is left, so each
text has a positive probability.

Counts of byte sequences are gathered from all training texts with Spark, and all
of them are kept. What a window of ``order`` + 1 bytes scores depends on that
window alone, so each distinct window is scored once: windows are dealt out by the
two bytes before their symbol, which brings every sequence of order 2 and above
that bears on a window to its task; orders 0 and 1 are at most 65,792 sequences
and go along. The scores of the most frequent windows are sent to every task, all
others are joined by window, aggregated by text first.

The unigram base joins the words of each document with the word counts of all
training texts. The few most frequent words go along with the tasks, all others
are joined by word, so no join key is hot.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import discard, id_hash, lean, materialize, worker_cache
from prismset.session import table

#: Context length in bytes.
ORDER = 5
#: Words and windows whose counts and scores are sent to every task. The others
#: are joined, so this changes the cost and never the result.
HOT_WORDS = 50_000
HOT_CODES = 1_000_000
#: Context bytes that windows are dealt out by, and rows of whole contexts of that
#: length that one trie is made of.
DEALT = 2
PIECE = 500_000
#: Bytes that no UTF-8 text holds: before the first word, after the last.
START, END = 0xFE, 0xFF
#: Bytes handled at once by the counting and scoring tasks, and words counted
#: before a task hands on what it has.
BATCH_BYTES = 512 << 10
WORDS_HELD = 150_000
MULT = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def normal(text: bytes | None) -> bytes:
    """Lower-cased words with one space between them."""
    return b" ".join((text or b"").lower().split())


def windows(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ``order`` + 1 bytes that end at each symbol; symbols of each text."""
    pad = bytes([START]) * order
    buf = np.frombuffer(b"".join(pad + t + bytes([END]) for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    code = np.zeros(len(buf) - order if len(buf) else 0, np.uint64)
    for k in range(order + 1):
        code = (code << np.uint64(8)) | buf[k : len(buf) - order + k]
    keep = np.ones(len(code), bool)  # windows that end in the padding of the next text
    ends = np.cumsum(sizes + order)[:-1] - order
    for k in range(order):
        keep[ends + k] = False
    return code[keep], sizes


def _count(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.r_[first, len(codes)])


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list, list[bytes]]]:
    """Rows of a batch in pieces of about BATCH_BYTES of normalised text."""
    for b in batches:
        ids, texts, held = [], [], 0
        for i in range(b.num_rows):
            t = normal(b.column(column)[i].as_py())
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= BATCH_BYTES:
                yield b, ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield b, ids, texts


def _gather(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task: words (word, count) and byte sequences (code, count).

    Rows are (text, trained). Of other texts the sequences are told apart from those
    learnt from, and the words are left out.
    """

    def words_out() -> pa.RecordBatch:
        ws, ns = list(words), list(words.values())
        return pa.RecordBatch.from_arrays([pa.nulls(len(ws), pa.int64()), pa.array(ws, pa.binary()), pa.array(ns, pa.int64()), pa.nulls(len(ws), pa.int64())], ["code", "word", "n", "m"])

    def codes_out() -> pa.RecordBatch:
        c, n, m = merged()
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)), pa.nulls(len(c), pa.binary()), pa.array(n), pa.array(m)], ["code", "word", "n", "m"])

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c, n, m = (np.concatenate(x) for x in zip(*parts, strict=True))
        o = np.argsort(c, kind="stable")
        c, n, m = c[o], n[o], m[o]
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.zeros(0, np.int64)
        return (c[first], np.add.reduceat(n, first), np.add.reduceat(m, first)) if len(c) else (c, n, m)

    words: Counter[bytes] = Counter()
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for b, rows, texts in _groups(batches, 0):
        learnt = b.column(1).take(pa.array(rows)).to_pylist()
        for is_learnt in (True, False):
            some = [t for t, x in zip(texts, learnt, strict=True) if x == is_learnt]
            if not some:
                continue
            if is_learnt:
                for t in some:
                    words.update(t.split())
                words[b""] += len(some)  # the end token
            c, m = _count(windows(some, order)[0])
            parts.append((c, m if is_learnt else np.zeros_like(m), m))
        if len(words) > WORDS_HELD:
            yield words_out()
            words = Counter()
        if len(parts) >= 8:
            parts = [merged()]
            if len(parts[0][0]) > 1_000_000:
                yield codes_out()
                parts = []
    if words:
        yield words_out()
    if parts:
        yield codes_out()


@dataclass
class Trie:
    """Open-addressing tables of each order: sequence or context to its logarithms."""

    order: int
    pairs: list[tuple[np.ndarray, np.ndarray]]  # of order j: log10 count
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # keys, norm, escape, norm and escape of the parent under exclusion
    rest: float  # log10 of one byte among those never seen

    def score(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each window's last symbol."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        above = np.full(len(codes), -1)  # the node escaped from, one order up
        for j in range(self.order, -1, -1):
            if not len(open_):
                break
            code = codes[open_] & np.uint64((1 << 8 * (j + 1)) - 1)
            pair = _find(self.pairs[j][0], code)
            up = above[open_]
            hit = pair >= 0
            node = np.where(hit & (up >= 0), 0, -2)
            need = node == -2
            node[need] = _find(self.nodes[j][0], code[need] >> np.uint64(8))
            _, norm, esc, _, _ = self.nodes[j]
            if j < self.order:
                norm_ex, esc_ex = self.nodes[j + 1][3], self.nodes[j + 1][4]
            else:
                norm_ex = esc_ex = np.zeros(1)
            k = open_[hit]
            out[k] += self.pairs[j][1][pair[hit]] - np.where(up[hit] >= 0, norm_ex[up[hit]], norm[np.maximum(node[hit], 0)])
            miss = ~hit
            k, n, u = open_[miss], node[miss], up[miss]
            seen = n >= 0
            out[k[seen]] += np.where(u[seen] >= 0, esc_ex[u[seen]], esc[n[seen]])
            above[k] = np.where(seen, n, -1)
            open_ = k
        out[open_] += self.rest
        return out


def _hash(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * MULT) >> np.uint64(64 - bits)).astype(np.int64)


def _table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of an open-addressing table at most two thirds full, and each key's slot."""
    bits = max(4, (3 * len(keys) // 2).bit_length())
    slots, at = np.full(1 << bits, EMPTY), np.zeros(len(keys), np.int64)
    left, pos = np.arange(len(keys)), _hash(keys, bits)
    while len(left):
        free = slots[pos] == EMPTY
        _, one = np.unique(pos[free], return_index=True)
        put = np.flatnonzero(free)[one]
        slots[pos[put]], at[left[put]] = keys[left[put]], pos[put]
        stay = np.ones(len(left), bool)
        stay[put] = False
        left, pos = left[stay], (pos[stay] + 1) & ((1 << bits) - 1)
    return slots, at


def _find(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Slot of each key, or -1."""
    bits = len(slots).bit_length() - 1
    out = np.full(len(keys), -1)
    left, pos = np.arange(len(keys)), _hash(keys, bits)
    while len(left):
        got = slots[pos]
        hit = got == keys[left]
        out[left[hit]] = pos[hit]
        stay = ~hit & (got != EMPTY)
        left, pos = left[stay], (pos[stay] + 1) & (len(slots) - 1)
    return out


def build(counts: list[tuple[np.ndarray, np.ndarray]], order: int) -> Trie:
    """The trie from (sorted codes, counts) of order 0 to ``order``."""
    pairs, nodes = [], []
    below: tuple | None = None
    for j, (codes, n) in enumerate(counts):
        ctx = codes >> np.uint64(8)
        first = np.flatnonzero(np.r_[True, ctx[1:] != ctx[:-1]]) if len(ctx) else np.zeros(0, np.int64)
        keys = ctx[first]
        total = np.add.reduceat(n, first).astype(float) if len(ctx) else np.zeros(0)
        kinds = np.diff(np.r_[first, len(ctx)]).astype(float)
        norm, esc = np.log10(total + kinds), np.log10(kinds) - np.log10(total + kinds)
        norm_ex, esc_ex = np.zeros(len(keys)), np.zeros(len(keys))
        if below is not None and len(keys):
            codes_b, n_b, keys_b, total_b, kinds_b = below
            same = n_b[np.searchsorted(codes_b, codes & np.uint64((1 << 8 * j) - 1))]
            up = np.searchsorted(keys_b, keys & np.uint64((1 << 8 * (j - 1)) - 1 if j > 1 else 0))
            left = total_b[up] - np.add.reduceat(same, first)
            new = kinds_b[up] - kinds
            some = new > 0
            norm_ex[some] = np.log10(left[some] + new[some])
            esc_ex[some] = np.log10(new[some]) - norm_ex[some]
        slots, at = _table(codes)
        val = np.zeros(len(slots), np.float32)
        val[at] = np.log10(n)
        pairs.append((slots, val))
        slots, at = _table(keys)
        cols = [np.zeros(len(slots), np.float32) for _ in range(4)]
        for c, x in zip(cols, (norm, esc, norm_ex, esc_ex), strict=True):
            c[at] = x
        nodes.append((slots, *cols))
        below = (codes, n, keys, total, kinds)
    seen = len(counts[0][0])
    return Trie(order, pairs, nodes, -np.log10(max(1, 256 - seen)))


def _shorter(codes: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the ends of order ``order`` of longer sequences: (sorted codes, counts)."""
    ends = codes & np.uint64((1 << 8 * (order + 1)) - 1)
    o = np.argsort(ends, kind="stable")
    ends, n = ends[o], n[o]
    first = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]]) if len(ends) else np.zeros(0, np.int64)
    return ends[first], np.add.reduceat(n, first) if len(ends) else n


def _score_windows(batches: Iterator[pa.RecordBatch], low: list[tuple[np.ndarray, np.ndarray]], order: int) -> Iterator[pa.RecordBatch]:
    """(code, m, lp) of rows (ctx, code, n, m) sorted by ctx, the bytes dealt out by.

    ``low`` has the counts of all training texts of the orders below DEALT. All
    rows of a ctx are taken together, as they hold all that its tries are made of.
    """

    def run(cols: list[np.ndarray]) -> pa.RecordBatch:
        _, codes, n, m = cols
        codes = codes.view(np.uint64)
        learnt = n > 0
        counts = [(codes[learnt], n[learnt])]
        for j in range(order, len(low) - 1, -1):
            counts.insert(0, _shorter(*counts[0], j))
        lp = build([*low, *counts[:-1]], order).score(codes)
        return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(m), pa.array(lp.astype(np.float32))], ["code", "m", "lp"])

    parts: list[list[np.ndarray]] = []
    held = 0
    for b in batches:
        if not b.num_rows:
            continue
        parts.append([c.to_numpy() for c in b.columns])
        held += b.num_rows
        if held < PIECE or parts[0][0][0] == parts[-1][0][-1]:
            continue
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)]
        k = np.searchsorted(cols[0], cols[0][-1])
        yield run([x[:k] for x in cols])
        parts = [[x[k:] for x in cols]]
        held = len(parts[0][0])
    if parts:
        yield run([np.concatenate(x) for x in zip(*parts, strict=True)])


def window_scores(codes: DataFrame, order: int) -> DataFrame:
    """(code, m, lp) for every window of (code, n, m): n among training texts, m in all texts."""
    spark = codes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = []
    for j in range(min(DEALT, order + 1)):
        one = codes.where("n > 0").groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1)).alias("end")).agg(F.sum("n").alias("n")).toArrow().to_pandas()  # at most 256 or 65,536 rows
        c, n = one["end"].to_numpy(np.int64).view(np.uint64), one["n"].to_numpy(np.int64)
        o = np.argsort(c)
        low.append((c[o], n[o]))
    dealt = codes.select(F.shiftrightunsigned("code", 8).bitwiseAND(F.lit((1 << 8 * DEALT) - 1)).alias("ctx"), "code", "n", "m")
    dealt = dealt.repartition(parts, "ctx").sortWithinPartitions("ctx")
    return dealt.mapInArrow(lambda it: lean(_score_windows(it, low, order)), "code long, m long, lp float")


def lm_score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held: int = 0, order: int = ORDER, hot_words: int = HOT_WORDS, hot_codes: int = HOT_CODES) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose id's CRC32 leaves a remainder other than ``held``.
    ``score`` is the log10 probability of the text's lower-cased words with one
    space between them and one end mark, ``base_score`` that of its words and end
    under the smoothed unigram model. A null text is an empty one (its end is
    scored); repeated rows are scored alike, also under one id or a null id. An
    empty table gives an empty result; with no training rows every byte is
    uniform and every word unknown.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    learnt = F.coalesce(id_hash(F.col("doc_id")), F.lit(0)) % folds != held
    partial = materialize(docs.select("text", learnt.alias("learnt")).mapInArrow(lambda it: lean(_gather(it, order)), "code long, word binary, n long, m long"), "partial")
    words = materialize(partial.where("word is not null").groupBy("word").agg(F.sum("n").alias("c")), "words")
    codes = materialize(partial.where("code is not null").groupBy("code").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "codes")
    discard(partial)
    total, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    hot = words.orderBy(F.desc("c"), "word").limit(hot_words).toArrow().to_pandas()  # bounded by hot_words
    lps = materialize(window_scores(codes, order), "windows")
    discard(codes)
    size = F.floor(F.log2("m") * 8)
    spread = lps.groupBy(size.alias("size")).agg(F.count("*").alias("rows")).toArrow().to_pandas().sort_values("size", ascending=False)  # at most 512 rows
    fits = spread["size"][spread["rows"].cumsum() <= hot_codes]
    often = lps.where(size >= F.lit(int(fits.min()) if len(fits) else 1 << 20)).select("code", "lp").toArrow()  # bounded by hot_codes
    slots, at = _table(often.column("code").to_numpy().view(np.uint64))
    values = np.zeros(len(slots), np.float32)
    values[at] = often.column("lp").to_numpy()
    table_ = spark.sparkContext.broadcast((slots, values))
    del often, slots, at, values
    known = spark.sparkContext.broadcast(dict(zip(hot["word"].map(bytes), hot["c"].tolist(), strict=True)))
    full = total + 0.1 * (kinds + 1)
    run = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and the words and windows that are not among the hot ones."""
        c, (slots, values) = known.value, table_.value
        logs = worker_cache(("ppm-hot", run), lambda: {w: float(np.log10((n + 0.1) / full)) for w, n in c.items()})
        for b, rows, texts in _groups(batches, 2):
            codes, sizes = windows(texts, order)
            pos = _find(slots, codes)
            got = np.add.reduceat(np.where(pos >= 0, values[pos], 0).astype(float), np.r_[0, np.cumsum(sizes)[:-1]])
            of, cold = np.repeat(np.arange(len(texts)), sizes)[pos < 0], codes[pos < 0]
            o = np.lexsort((cold, of))
            of, cold = of[o], cold[o]
            first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (cold[1:] != cold[:-1])]) if len(of) else np.zeros(0, np.int64)
            of, cold, times = of[first], cold[first], np.diff(np.r_[first, len(of)])
            ids = b.column(0).take(pa.array(rows))
            out = [[], [], [], []]
            for t in texts:
                tokens = [*t.split(), b""]
                mine = [logs[w] for w in tokens if w in logs]
                rest = Counter(w for w in tokens if w not in logs)
                out[0].append(len(tokens))
                out[1].append(len(mine))
                out[2].append(sum(mine))
                out[3].append(list(rest.items()))
            rare = pa.array([[{"w": w, "k": k} for w, k in r] for r in out[3]], pa.list_(pa.struct([("w", pa.binary()), ("k", pa.int64())])))
            starts = pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32))
            far = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays([pa.array(cold.view(np.int64)), pa.array(times)], ["code", "k"]))
            yield pa.RecordBatch.from_arrays([ids, b.column(1).take(pa.array(rows)), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(got), rare, far], ["row", "doc_id", "n_tokens", "known", "base", "score", "rare", "far"])

    scored = materialize(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(lambda it: lean(score(it)), "row long, doc_id long, n_tokens long, known long, base double, score double, rare array<struct<w:binary,k:long>>, far array<struct<code:long,k:long>>"),
        "scored",
    )
    rare = scored.select("row", F.explode("rare").alias("x")).select("row", F.col("x.w").alias("word"), F.col("x.k").alias("k"))
    rare = rare.join(words, "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("more"), F.sum(F.col("k") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(full))).alias("less"))
    far = scored.select("row", F.explode("far").alias("x")).select("row", "x.code", "x.k").join(lps.select("code", "lp"), "code")
    far = far.groupBy("row").agg(F.sum(F.col("k") * F.col("lp").cast("double")).alias("far_score"))
    return scored.drop("rare", "far").join(rare, "row", "left").join(far, "row", "left").select(
        "doc_id",
        (F.coalesce(id_hash(F.col("doc_id")), F.lit(0)) % folds == held).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("less", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("far_score", F.lit(0.0))).alias("score"),
    )


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPM and unigram scores of all ``documents``."""
    return lm_score(table(spark, sf_dir, "documents"))
