"""The corpus pipeline over a whole small table, stage by stage against brute force."""

import os

import numpy as np
import pytest

import corpus_pipeline
from prismset.llm import packing, simhash
from prismset.llm.common import SPACE, materialize

SF = "/root/testdata/sf0.001"


def shingled(text, words=5):
    w = text.encode().lower().split()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the synthetic tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {"input": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "pack":
            assert out.dtypes == docs.dtypes
        docs = materialize(out, name)
        got[name] = docs.collect()
    by_id = {r.doc_id: r.text for r in got["input"]}
    assert all(by_id[r.doc_id] == r.text for n in ("quality", "exact_dedup", "near_dedup") for r in got[n])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in got["quality"]}
    wrong = sum((i in kept) != (q == 1) for i, q in labels.items())
    assert wrong <= 0.05 * len(labels)

    norm = lambda t: (t or "").encode().translate(None, SPACE)
    assert len({norm(r.text) for r in got["exact_dedup"]}) == len(got["exact_dedup"]) == len({norm(r.text) for r in got["quality"]})

    sets = {r.doc_id: shingled(r.text) for r in got["exact_dedup"]}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    assert {r.doc_id for r in got["near_dedup"]} == {find(i) for i in ids}

    words = lambda rows: sum(len(r.text.encode().split()) for r in rows)
    assert abs(words(got["mix"]) - 1.5 * words(got["near_dedup"])) <= 0.01 * words(got["near_dedup"])

    ids_of = packing.WordIds(packing.default_tokenizer())
    total = sum(len(ids_of.text(r.text.encode(), b"1234")) // 4 for r in got["mix"])
    assert sum(r.length for r in got["pack"]) == total


def test_near_copies_at_the_bound(spark):
    """Texts with words appended or cut off, at five-word similarities of 0.80 to 0.90."""
    rng = np.random.default_rng(11)
    data, pairs = [], []
    for k in range(400):
        n = int(rng.integers(100, 600))
        base = [f"w{x}" for x in rng.integers(0, 5000, n)]
        share = 0.802 + 0.098 * k / 400
        more = int((n - 4) / share) - (n - 4) if k % 2 else int((n - 4) * (1 - share))
        other = base + [f"n{x}" for x in rng.integers(0, 5000, more)] if k % 2 else base[: n - more]
        data += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
        a, b = (shingled(t) for _, t in data[-2:])
        if len(a & b) >= 0.8 * len(a | b):
            pairs.append((2 * k, 2 * k + 1))
    assert len(pairs) >= 395
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.99 * len(pairs)
    assert all(got[i] in (i, i ^ 1) for i in got)


def test_near_stage_follows_simhash(spark):
    """Short copies with a word replaced, below a five-word similarity of 0.8 but within four bits: one of them stays."""
    rng = np.random.default_rng(12)
    data, close = [], []
    while len(close) < 5:
        words = [f"w{x}" for x in rng.integers(0, 5000, 42)]
        other = [*words[:20], f"n{rng.integers(0, 5000)}", *words[21:]]
        a, b = " ".join(words), " ".join(other)
        if (simhash.fingerprint(a.encode(), 4) ^ simhash.fingerprint(b.encode(), 4)).bit_count() <= 4:
            assert len(shingled(a) & shingled(b)) < 0.8 * len(shingled(a) | shingled(b))
            close.append(len(data))
            data += [(len(data), a), (len(data) + 1, b)]
        else:
            data.append((len(data), a))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, SF).collect()} == set(range(len(data))) - {k + 1 for k in close}
