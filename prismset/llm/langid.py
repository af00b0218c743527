"""Language identification with a bidirectional gated recurrent network over bytes.

Texts are cut into windows of WINDOW bytes. One GRU reads a window forwards, one
backwards; their states label every position, and the probabilities of all
positions of a text are averaged. The network is trained in numpy by
backpropagation through time on windows of a bounded sample of each language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prismset.llm.common import id_hash, lean, materialize, row_key
from prismset.session import table

#: Bytes of a window, units of each direction.
WINDOW = 64
UNITS = 16
#: Training documents of a language at most, windows of a document at most (both
#: parameters of ``identify``), windows of a step, steps.
SAMPLE_PER_LANG = 400
WINDOWS_PER_DOC = 6
BATCH = 64
STEPS = 350
#: Windows that are run through the network at once.
RUN = 2048
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class BiGru:
    """Parameters and passes of the network; float32 throughout."""

    def __init__(self, classes: int, units: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        h = units
        self.units = h
        self.p = {}
        for d in "fb":  # gates in the order update, reset, candidate
            self.p[f"x{d}"] = (rng.standard_normal((256, 3 * h)) * 0.3).astype(np.float32)
            self.p[f"u{d}"] = (rng.standard_normal((h, 3 * h)) / np.sqrt(h)).astype(np.float32)
            self.p[f"o{d}"] = (rng.standard_normal((h, classes)) / np.sqrt(h)).astype(np.float32)
        self.p["b"] = np.zeros(classes, np.float32)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States of a direction over (batch, time) bytes; what training needs of each step."""
        h, hu = np.zeros((len(x), self.units), np.float32), self.units
        wx, u = self.p[f"x{d}"], self.p[f"u{d}"]
        states = np.zeros((x.shape[1], len(x), hu), np.float32)
        held = []
        for t in range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1):
            g = wx[x[:, t]]
            s = h @ u
            zr = _sigmoid(g[:, : 2 * hu] + s[:, : 2 * hu])
            z, r = zr[:, :hu], zr[:, hu:]
            n = np.tanh(g[:, 2 * hu :] + r * s[:, 2 * hu :])
            new = (n + z * (h - n)) * mask[:, t, None]
            if keep:
                held.append((t, h, z, r, n, s[:, 2 * hu :]))
            h = states[t] = new
        return states, held

    def _states(self, d: str, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The states of ``_run``, worked out in place, each gate in arrays of its own.

        A logistic gate is (1 + tanh(a / 2)) / 2: its weights are halved beforehand,
        as is what the reset gate multiplies.
        """
        hu = self.units
        wz, wr, wn = (np.ascontiguousarray(w) for w in np.split(self.p[f"x{d}"], 3, axis=1))
        wz, wr = wz * np.float32(0.5), wr * np.float32(0.5)
        uz, ur, un = (np.ascontiguousarray(w) * np.float32(0.5) for w in np.split(self.p[f"u{d}"], 3, axis=1))
        h = np.zeros((len(x), hu), np.float32)
        states = np.empty((x.shape[1], len(x), hu), np.float32)
        z, r, n, s = (np.empty_like(h) for _ in range(4))
        whole = mask.all(axis=0)
        columns = np.ascontiguousarray(x.T).astype(np.intp)
        for t in range(x.shape[1]) if d == "f" else range(x.shape[1] - 1, -1, -1):
            for gate, w, u in ((z, wz, uz), (r, wr, ur)):
                w.take(columns[t], axis=0, out=gate, mode="clip")
                gate += np.matmul(h, u, out=s)
                np.tanh(gate, out=gate)
                gate += 1
            z *= 0.5
            wn.take(columns[t], axis=0, out=n, mode="clip")
            np.matmul(h, un, out=s)
            s *= r
            n += s
            np.tanh(n, out=n)  # the candidate
            new = states[t]
            np.subtract(h, n, out=new)
            new *= z
            new += n
            if not whole[t]:
                new *= mask[:, t, None]
            h = new
        return states

    def positions(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probabilities (class, time, batch) of every position."""
        y = self.p["of"].T @ self._states("f", x, mask).reshape(-1, self.units).T
        y += self.p["ob"].T @ self._states("b", x, mask).reshape(-1, self.units).T
        y += self.p["b"][:, None]
        y -= y.max(axis=0)
        np.exp(y, out=y)
        y /= y.sum(axis=0)
        return y.reshape(-1, x.shape[1], len(x))

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the positions and its gradients (BPTT)."""
        runs = {d: self._run(d, x, mask, True) for d in "fb"}
        y = self.p["b"] + runs["f"][0] @ self.p["of"] + runs["b"][0] @ self.p["ob"]
        y = y - y.max(axis=-1, keepdims=True)
        q = np.exp(y) / np.exp(y).sum(axis=-1, keepdims=True)
        m = mask.T / max(1.0, float(mask.sum()))
        loss = -float((np.log(q[:, np.arange(len(x)), label] + 1e-9) * m).sum())
        dy = q.copy()
        dy[:, np.arange(len(x)), label] -= 1
        dy *= m[:, :, None]
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["b"] = dy.sum(axis=(0, 1))
        hu = self.units
        for d in "fb":
            states, held = runs[d]
            g[f"o{d}"] = np.einsum("tbh,tbk->hk", states, dy)
            dstates = dy @ self.p[f"o{d}"].T
            dh = np.zeros((len(x), hu), np.float32)
            for t, h, z, r, n, s in reversed(held):
                dh = (dh + dstates[t]) * mask[:, t, None]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * s * r * (1 - r)
                da = np.concatenate([dz, dr, dn], axis=1)
                ds = np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(g[f"x{d}"], x[:, t], da)
                g[f"u{d}"] += h.T @ ds
                dh = dh * z + ds @ self.p[f"u{d}"].T
        return loss, g


def train(windows: list[bytes], labels: np.ndarray, classes: int, units: int = UNITS, steps: int = STEPS, batch: int = BATCH, seed: int = 42) -> BiGru:
    """Adam on batches that hold every class alike."""
    net, rng = BiGru(classes, units, seed), np.random.default_rng(seed)
    x, mask, _ = as_windows(windows)
    by = [np.flatnonzero(labels == k) for k in range(classes)]
    m, v = ({k: np.zeros_like(p) for k, p in net.p.items()} for _ in range(2))
    for t in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, max(1, batch // classes)) for b in by if len(b)])
        _, g = net.gradients(x[pick], mask[pick], labels[pick])
        norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        rate = 0.02 * min(1.0, 3 * (1 - t / (steps + 1)))
        for k, p in net.p.items():
            a = g[k] / max(1.0, norm)
            m[k] = 0.9 * m[k] + 0.1 * a
            v[k] = 0.99 * v[k] + 0.01 * a * a
            p -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
    return net


def as_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and mask (window, position) of all texts; windows of each text."""
    n = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    x = np.frombuffer(b"".join(t.ljust(k * WINDOW, b"\0") for t, k in zip(texts, n.tolist(), strict=True)), np.uint8).reshape(-1, WINDOW)
    mask = np.ones(x.shape, np.float32)
    ends = np.cumsum(n) - 1
    for e, t in zip(ends, texts, strict=True):
        if len(t) % WINDOW:
            mask[e, len(t) % WINDOW :] = 0
    return x, mask, n


def pool(net: BiGru, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all positions of each (non-empty) text."""
    x, mask, n = as_windows(texts)
    sums = np.concatenate([(net.positions(x[i : i + RUN], mask[i : i + RUN]) * mask[i : i + RUN].T).sum(axis=1).T for i in range(0, len(x), RUN)])
    total = np.add.reduceat(sums, np.r_[0, np.cumsum(n)[:-1]], axis=0)
    return total / np.array([len(t) for t in texts], np.float32)[:, None]


def _sample(batches: Iterator[pa.RecordBatch], windows: int) -> Iterator[pa.RecordBatch]:
    """(lang, doc_id, window) for up to ``windows`` windows of each training document."""
    for b in batches:
        lang, ids, out = [], [], []
        for k, (i, t) in enumerate(zip(b.column(1).to_pylist(), b.column(2), strict=True)):
            t = t.as_py() or b""
            n = -(-len(t) // WINDOW)
            for j in np.random.default_rng(abs(i or 0)).permutation(n)[:windows]:
                lang.append(b.column(0)[k].as_py())
                ids.append(i)
                out.append(t[j * WINDOW : (j + 1) * WINDOW])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["lang", "doc_id", "window"])


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held: int = 0, sample: int = SAMPLE_PER_LANG, windows: int = WINDOWS_PER_DOC, seed: int = 42) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from text and non-null language of rows whose id's CRC32 leaves a
    remainder other than ``held``: of every language that occurs, however rare, at
    most ``sample`` documents (lowest seeded md5 of the id), of each at most
    ``windows`` windows of WINDOW bytes, dealt over the whole text. Texts that are
    null or hold no letter are ``und`` with score 0; so is every text if there is
    nothing to learn from. Whole texts are read to predict them, however long.
    Repeated rows are learned from once and predicted alike; an empty table gives
    an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("doc_id").isNotNull() & (id_hash(F.col("doc_id")) % folds != held)).withColumn("key", row_key(docs))
    place = F.md5(F.concat(F.lit(f"{seed}|"), F.col("doc_id").cast("string")))
    # about twice the sample of each language is dealt out, then cut exactly
    counts = materialize(known.groupBy("lang").agg(F.count("*").alias("n")), "languages")  # a row for each; sent to every task while that is small
    some = known.select("lang", "key", place.alias("place")).join(counts, "lang").where(F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / 2.0**32 * F.col("n") < 2.0 * sample + 100.0)
    few = some.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("place", "key"))).where(F.col("k") <= sample)
    few = materialize(few.select("key").distinct(), "picked")  # of a known size, so that the planner sends it to every task while it is small
    got = known.join(few, "key", "left_semi").dropDuplicates(["key"]).select("lang", "doc_id", F.col("text").cast("binary").alias("text"))
    got = got.mapInArrow(lambda it: _sample(it, windows), "lang string, doc_id long, window binary").orderBy("lang", "doc_id", "window").toArrow().to_pandas()  # at most sample * windows of a language
    langs = sorted(got["lang"].unique().tolist())
    net = train([bytes(w) for w in got["window"]], got["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(np.int64), len(langs), seed=seed) if langs else None

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            some = [k for k, t in enumerate(texts) if t]
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if some and net is not None:
                p = pool(net, [texts[k] for k in some])
                best = p.argmax(axis=1)
                for k, c, s in zip(some, best.tolist(), p[np.arange(len(p)), best].tolist(), strict=True):
                    pred[k], score[k] = langs[c], min(1.0, s)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(pred), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(i)
                texts.append(t.as_py())
                size += len(texts[-1] or b"") // WINDOW + 1
                if size >= RUN:
                    yield out()
                    ids, texts, size = [], [], 0
            if ids:
                yield out()

    said = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary")).alias("text")).mapInArrow(lambda it: lean(predict(it)), "doc_id long, lang_pred string, score double")
    return said.select("doc_id", (F.coalesce(id_hash(F.col("doc_id")), F.lit(0)) % folds == held).alias("held_out"), "lang_pred", "score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``."""
    return identify(table(spark, sf_dir, "documents"))
