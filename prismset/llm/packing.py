"""Packing documents into fixed windows by non-negative least squares.

A task tokenizes its documents and packs them buffer by buffer. What is left of
each document after whole windows falls into length classes; all combinations of
at most DEPTH classes that fill a window exactly are enumerated, and the repeat
counts that best reproduce the length histogram are solved for by non-negative
least squares. Rounded down, they say which documents share a window. Everything
else is packed greedily: it is cut to fill the gaps that the classes left, and
the rest is laid out window after window. A task's last, shorter stretch is cut
at powers of two, so nothing is padded.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismset.llm.common import lean, worker_cache
from prismset.session import table

WINDOW = 4096
END_ID = 2
#: Length classes of a window, and documents of a combination.
CLASSES = 32
DEPTH = 4
#: Tokens of a buffer, and words whose ids a worker remembers (twice over).
BUFFER_TOKENS = 2_000_000
#: ASCII marks that never join a letter or digit before them in one token.
MARKS = b".,;:!?*$%&#|"
WORDS_HELD = 400_000


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min |a x - b| with x >= 0, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, inside = np.zeros(n), np.zeros(n, bool)
    for _ in range(3 * n):
        g = a.T @ (b - a @ x)
        g[inside] = -np.inf
        j = int(g.argmax())
        if g[j] <= 1e-8 * max(1.0, float(np.abs(b).max())):
            break
        inside[j] = True
        while True:
            k = np.flatnonzero(inside)
            s = np.linalg.lstsq(a[:, k], b, rcond=None)[0]
            if (s > 0).all():
                x[:] = 0
                x[k] = s
                break
            low = s <= 0
            step = np.min(x[k][low] / np.maximum(x[k][low] - s[low], 1e-300))
            x[k] += step * (s - x[k])
            x[k[x[k] <= 1e-12]] = 0
            inside &= x > 0
            if not inside.any():
                break
    return x


def combinations(classes: int = CLASSES, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` classes (1 to ``classes``) that sum to ``classes``."""
    out = []
    for d in range(1, depth + 1):
        for head in combinations_with_replacement(range(1, classes + 1), d - 1):
            last = classes - sum(head)
            if last >= (head[-1] if head else 1):
                out.append((*head, last))
    return out


def plan(lengths: list[int], window: int = WINDOW, tail: bool = True) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that fill the window, and what is left.

    With ``tail`` the rest is cut into sequences of a power of two, and nothing
    is left.
    """
    full = [[(d, k, window)] for d, n in enumerate(lengths) for k in range(0, n - window + 1, window)]
    rests = [(d, n - n % window, n % window) for d, n in enumerate(lengths) if n % window]
    unit = -(-window // CLASSES)
    stacks: list[list[tuple[int, int, int]]] = [[] for _ in range(CLASSES + 1)]
    for r in sorted(rests, key=lambda r: (r[2], r[0])):
        stacks[-(-r[2] // unit)].append(r)
    combos = worker_cache(("packing", CLASSES, DEPTH), combinations)
    a = np.zeros((CLASSES, len(combos)))
    for j, c in enumerate(combos):
        for k in c:
            a[k - 1, j] += 1
    counts = np.floor(nnls(a, np.array([len(s) for s in stacks[1:]], float)) + 1e-6).astype(int)
    shared = []
    for j in np.argsort(-counts, kind="stable"):
        need = {k: combos[j].count(k) for k in combos[j]}
        for _ in range(min([counts[j], *(len(stacks[k]) // m for k, m in need.items())])):
            shared.append([stacks[k].pop() for k in combos[j]])
    left = [r for s in reversed(stacks) for r in s]
    # fill the gaps of shared windows; windows with the largest gaps are undone until the rest suffices
    gap = lambda s: window - sum(p[2] for p in s)
    shared.sort(key=gap)
    gaps, supply = sum(map(gap, shared)), sum(r[2] for r in left)
    while shared and gaps > supply:
        s = shared.pop()
        gaps -= gap(s)
        supply += window - gap(s)
        left += s
    left.reverse()

    def fill(s: list[tuple[int, int, int]], room: int) -> list[tuple[int, int, int]]:
        while room:
            d, at, n = left.pop()
            take = min(n, room)
            s.append((d, at, take))
            if n > take:
                left.append((d, at + take, n - take))
            room -= take
        return s

    out = full + [fill(s, gap(s)) for s in shared]
    rest = sum(r[2] for r in left)
    while rest >= window:
        out.append(fill([], window))
        rest -= window
    if tail:
        for k in range(rest.bit_length() - 1, -1, -1):
            if rest >> k & 1:
                out.append(fill([], 1 << k))
    return out, left[::-1]


class WordIds(dict):
    """Token ids (little-endian unsigned 32-bit) of words, remembered in two generations.

    The tokenizer lower-cases and never joins text across ASCII white space, so a
    text's ids are those of its lower-cased words, one after the other. Words that
    hold an added token, in its own case, are left to the tokenizer as they stand.
    """

    def __init__(self, path: str, held: int = WORDS_HELD) -> None:
        super().__init__()
        self.held = held
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.marks = [t.content.encode() for t in self.plain.get_added_tokens_decoder().values()]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # for words that hold no added token, also when lower-cased
        self.old: dict[bytes, bytes] = {}
        # the byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes follow from U+0100
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.letters = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        core = word.rstrip(MARKS)
        if ids is None and core != word and core[-1:].isalnum():  # the marks are a token run of their own
            ids = self[core] + self[word[len(core) :]]
        if ids is None:
            ids = self._encode(word.decode("utf-8", "replace"))
            ids = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = ids
        return ids

    def _encode(self, word: str) -> list[int]:
        """A composed word of Latin letters is one run of letters: the model alone does."""
        if word.isascii() and word.isalpha():
            return [t.id for t in self.tokenizer.model.tokenize(word)]
        if word.isalpha() and max(word) < "\u0250" and word == word.lower() and unicodedata.is_normalized("NFC", word):
            return [t.id for t in self.tokenizer.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def text(self, text: bytes, end: bytes) -> bytes:
        if len(self) > self.held:
            self.old = dict(self)
            self.clear()
        if any(m in text for m in self.marks):
            return b"".join(self._marked(w) if any(m in w for m in self.marks) else self[w.lower()] for w in text.split()) + end
        return b"".join(map(self.__getitem__, text.lower().split())) + end

    def _marked(self, word: bytes) -> bytes:
        ids = self.plain.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, buffer_tokens: int = BUFFER_TOKENS, words_held: int = WORDS_HELD) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Every id of every document lies in exactly one piece; a null or empty text is
    its end id alone. A sequence is ``window`` ids long or, at the end of a task,
    a power of two. ``sequence_id`` is unique over all tasks (the task's number in
    the upper bits). Rows repeated under one id, or with a null id, are documents
    of their own. An empty table gives no piece. ``tokenizer`` is a path that every
    executor can read. No rows are shuffled: each task packs what it reads.
    ``words_held`` trades memory of the workers (about 400 bytes a word) for time and
    never changes a piece.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_cache(("word-ids", path, words_held), lambda: WordIds(path, words_held))
        end = np.array([end_id], "<u4").tobytes()
        seq = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        # what a buffer left over: (doc_id, ids of the piece, its start, tokens of the document)
        docs: list[tuple[int | None, bytes, int, int]] = []

        def out(tail: bool) -> Iterator[pa.RecordBatch]:
            nonlocal seq, docs
            sequences, left = plan([len(d[1]) // 4 for d in docs], window, tail)
            cols: list[list] = [[] for _ in range(8)]
            for s in sequences:
                at = 0
                for d, start, n in s:
                    id_, ids, base, total = docs[d]
                    part = ids[4 * start : 4 * (start + n)]
                    for c, v in zip(cols, (id_, base + start, n, zlib.crc32(part), total, seq, at, part if with_ids else None), strict=True):
                        c.append(v)
                    at += n
                seq += 1
            docs = [(docs[d][0], docs[d][1][4 * start : 4 * (start + n)], docs[d][2] + start, docs[d][3]) for d, start, n in left]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols[7], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

        held = 0
        for b in batches:
            for id_, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = words.text(t.as_py() or b"", end)
                docs.append((id_, ids, 0, len(ids) // 4))
                held += len(ids) // 4
                if held >= buffer_tokens:
                    yield from out(False)
                    held = sum(len(d[1]) // 4 for d in docs)
        if docs:
            yield from out(True)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(lambda it: lean(run(it)), schema)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 4096 ids."""
    return pack(table(spark, sf_dir, "documents"))
