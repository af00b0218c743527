"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text. The weights come
from preference pairs (a document labelled 1 over one labelled 0): logistic loss
on the feature differences, the Bradley-Terry likelihood. The threshold is the
score quantile at the share of label 0, and the reported score is the chance
that the document beats one that lies on the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import id_hash, lean
from prismset.session import table

#: Labelled rows of each class that training reads at most (those with the
#: lowest md5 of their id), preference pairs of a step, steps.
SAMPLE_PER_CLASS = 4000
PAIRS = 512
STEPS = 1500
#: Classes of bytes: other, lower, upper, digit, space, line end, sentence end,
#: other prose marks, bar, exclamation and question marks, symbols, non-ASCII.
CLASSES = 12


def _byte_classes() -> np.ndarray:
    lut = np.zeros(256, np.int64)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c", b"\r\n", b".:;", b",'\"()-", b"|", b"!?", b"#$%&*@^~_=+<>/\\{}[]`"), 1):
        lut[list(chars)] = k
    lut[128:] = 11
    return lut


def features(text: bytes, lut: np.ndarray) -> np.ndarray:
    """Shares of byte-class pairs and repetition, over the whole text."""
    out = np.zeros(CLASSES * CLASSES + 10, np.float64)
    codes = lut[np.frombuffer(text, np.uint8)]
    if len(codes) > 1:
        out[: CLASSES * CLASSES] = np.sqrt(np.bincount(codes[:-1] * CLASSES + codes[1:], minlength=CLASSES * CLASSES) / (len(codes) - 1))
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    if n:
        low = text.lower().split()
        letters = max(1, int(((codes == 1) | (codes == 2) | (codes == 11)).sum()))
        same = sum(map(bytes.__eq__, words, words[1:]))
        out[CLASSES * CLASSES :] = (
            np.log1p(n) / 5,
            np.sqrt(same / n),
            np.sqrt(len(set(low)) / n),
            len(set(low)) / n**0.8,
            min(len(text) / n, 40) / 10,
            np.sqrt((codes == 2).sum() / letters),
            np.sqrt(len(set(lines)) / len(lines)),
            np.log1p(n / len(lines)) / 5,
            np.sqrt((codes == 10).sum() / len(codes)),
            np.sqrt((codes == 3).sum() / len(codes)),
        )
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, doc_id, features) of labelled rows."""
    lut = _byte_classes()
    for b in batches:
        rows = [features(t.as_py() or b"", lut).tolist() for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.float64()))], ["label", "doc_id", "x"])


def fit(x: np.ndarray, y: np.ndarray, share: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, seed: int = 42) -> tuple[np.ndarray, float]:
    """Weights and threshold from features, labels and class shares (of 0, of 1).

    Without both classes there are no preferences: every score is then 0.5.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(x.shape[1] if x.size else CLASSES * CLASSES + 10)
    if not len(good) or not len(bad):
        return w, 0.0
    scale = 1 / np.maximum(x.std(axis=0), 0.02)
    z = (x - x.mean(axis=0)) * scale
    rng = np.random.default_rng(seed)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        lost = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        g = -(d * lost[:, None]).mean(axis=0) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    s = z @ w
    mass = np.where(y == 1, share[1] / len(good), share[0] / len(bad))
    order = np.argsort(s, kind="stable")
    k = min(int(np.searchsorted(np.cumsum(mass[order]), share[0] - 1e-9)), len(s) - 2)
    cut = (s[order[k]] + s[order[k + 1]]) / 2
    w = w * scale
    return w, float(cut + x.mean(axis=0) @ w)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", folds: int = 3, held: int = 1, sample: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, float]:
    """Weights and threshold learned from the labelled rows of (doc_id, text as bytes)."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & (id_hash(F.col("doc_id")) % folds != held))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    picked = None
    for k in (0, 1):
        one = known.where(F.col("label") == k).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
        picked = one if picked is None else picked.unionByName(one)
    rows = docs.join(F.broadcast(picked), "doc_id").groupBy("label", "doc_id").agg(F.min("text").alias("text"))  # of several rows of one id the first text
    got = rows.mapInArrow(lambda it: lean(_features(it)), "label int, doc_id long, x array<double>").orderBy("doc_id", "label").toArrow().to_pandas()  # at most 2 * sample ids
    x = np.array(got["x"].tolist(), dtype=np.float64)
    share = np.array([counts.get(0, 0), counts.get(1, 0)], float)
    return fit(x, got["label"].to_numpy(), share / max(1.0, share.sum()))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 3, held: int = 1, sample: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted (0 or 1).

    Learns only from labels whose id's CRC32 leaves a remainder other than
    ``held``; the label is no input of any score. Null texts score as empty ones;
    null labels and ids are not learned from. Without labels of both kinds every
    score is 0.5. Repeated rows are scored alike; an empty table gives none.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    w, cut = fit_quality(docs, labels, id_col, label_col, folds, held, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lut = _byte_classes()
        for b in batches:
            s = np.fromiter((features(t.as_py() or b"", lut) @ w - cut for t in b.column(1)), float, b.num_rows)
            p = 1 / (1 + np.exp(-np.clip(s, -500, 500)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], ["doc_id", "score"])

    out = docs.mapInArrow(lambda it: lean(score(it)), "doc_id long, score double")
    return out.select("doc_id", (F.coalesce(id_hash(F.col("doc_id")), F.lit(-1)) % folds == held).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 3, held: int = 1) -> DataFrame:
    """The rows of ``df``, all columns, that ``score_quality`` predicts as 1; no row moves."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    w, cut = fit_quality(docs, labels, id_col, label_col, folds, held)
    at = df.columns.index(text_col)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lut = _byte_classes()
        for b in batches:
            yield b.filter(pa.array([features((t.as_py() or "").encode(), lut) @ w >= cut for t in b.column(at)], pa.bool_()))

    return df.mapInArrow(lambda it: lean(good(it)), df.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all ``documents``, learned from ``labels``."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
