"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import zlib
from collections import Counter

import numpy as np
import pytest

from prismset.llm import chat, components, embeddings, exactdedup, langid, linededup, minhash, mixing, packing, ppm, quality, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the quick brown fox jumps over a lazy dog while seven old sailors watch the rising tide of grey water".split()


def text(k: int, n: int = 60) -> str:
    rng = np.random.default_rng(k)
    return " ".join(rng.choice(WORDS, n)) + f" end{k}"


def rows():
    long = text(99, 60_000)
    out = [(k, text(k), "en" if k % 2 else None, f"s{k % 3}", 0) for k in range(20)]
    out += [(20, None, None, None, None), (21, "", "en", None, 0), (22, " \t\n", "en", "s1", 3), (23, long, "en", "s1", len(long)), (24, text(1), "en", "s1", 0)]
    out += [(25, text(2) + " ", None, "s2", 0), (7, text(7), "en", "s1", 0), (None, text(3), "en", "s0", 0), (26, "é ü 日本 😀", "xx", "s0", 9)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    # columns that the operators use inside themselves must not get in the way
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows()], SCHEMA + ", size int, key string, block int, row string, hash int").cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA).cache()


def test_exact_dedup(docs, none):
    got = {r.doc_id: r for r in exactdedup.exact_dedup(docs).collect()}
    assert got[24].keep_id == 1 and not got[24].kept and got[1].kept
    assert got[25].kept and got[2].keep_id == 25  # the longer original stays
    assert got[20].keep_id == got[21].keep_id == got[22].keep_id == 22 and got[20].group_size == 3
    assert got[7].group_size == 2 and got[7].kept and got[None].keep_id == 3
    assert exactdedup.exact_dedup(docs).count() == len(rows())
    assert exactdedup.exact_dedup(none).count() == 0


def test_grace_spills_and_compares_whole_contents():
    contents = [f"{k % 300}".encode() * 50 for k in range(3000)] + [b"a", b"b"]
    same_hash = 5  # all in one bucket at every level
    for h in (lambda c: zlib.crc32(c) << 32, lambda c: same_hash):
        got = list(exactdedup.grace(((h(c), c, 1, (-len(c), False, k, 0), [k]) for k, c in enumerate(contents)), 2000))
        assert Counter({e.content: e.count for e in got}) == Counter(contents)
        assert len(got) == len(set(contents)) and sorted(p for e in got for p in e.parts) == list(range(len(contents)))


def test_mixing(docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows()) and all(0 <= r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    targets = {r.source: (r.target, r.source_size) for r in got}
    assert abs(sum(t for t, _ in targets.values()) - 1.5 * total) < 1e-6 * total
    assert all(t <= 2 * s + 1e-9 for t, s in targets.values())
    for s, (t, _) in targets.items():
        assert abs(sum(r.taken for r in got if r.source == s) - t) <= 2 * 256
    assert sorted((r.doc_id is None, r.doc_id or 0, r.taken) for r in mixing.mix(docs.repartition(7)).collect()) == sorted((r.doc_id is None, r.doc_id or 0, r.taken) for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    assert sum(r.taken for r in mixing.mix(docs.where("doc_id in (20, 21, 22)")).collect()) == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and sum(len(r.text.split()) for r in out.where("doc_id <> 26 and doc_id <> 7").collect()) == sum(r.taken for r in got if r.doc_id not in (7, 26, None))


def test_apportionment_follows_the_highest_quotients(spark):
    rng = np.random.default_rng(0)
    for case in range(3):
        shares = rng.integers(1, 1000, 12).astype(float)
        n = int(rng.integers(40, 300))
        df = spark.createDataFrame([(f"p{k:02}", float(s), n) for k, s in enumerate(shares)], "source string, share double, n long")
        got = {r.source: r.seats for r in mixing._seats(df, "", "source").collect()}
        order = sorted(((-s / (2 * k + 1), f"p{j:02}", k) for j, s in enumerate(shares) for k in range(n)))[:n]
        assert {k: v for k, v in got.items() if v} == Counter(x[1] for x in order), case


def test_language(docs, none):
    got = {r.doc_id: r for r in langid.identify(docs, sample=20).collect()}
    assert got[20].lang_pred == got[21].lang_pred == got[22].lang_pred == "und" and got[20].score == 0
    assert all(0 <= r.score <= 1 for r in got.values()) and got[23].lang_pred in ("en", "xx")
    assert langid.identify(none).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang is null")).collect()} == {"und"}


def test_gradients_of_the_network():
    rng = np.random.default_rng(3)
    net = langid.BiGru(3, 4, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, label = rng.integers(0, 256, (5, 7)), np.array([0, 1, 2, 1, 0])
    mask = np.ones((5, 7))
    mask[3, 4:] = 0
    _, g = net.gradients(x, mask, label)
    for k, p in net.p.items():
        for at in np.argsort(-np.abs(g[k]).ravel())[:4]:
            at = np.unravel_index(at, p.shape)
            was, e = p[at], 1e-4
            p[at] = was + e
            up = net.gradients(x, mask, label)[0]
            p[at] = was - e
            down = net.gradients(x, mask, label)[0]
            p[at] = was
            assert g[k][at] == pytest.approx((up - down) / (2 * e), rel=2e-3, abs=1e-5), k


def test_inference_equals_the_training_pass():
    rng = np.random.default_rng(5)
    net = langid.BiGru(3, 8, 2)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (1, 63, 64, 65, 300)]
    x, mask, n = langid.as_windows(texts)
    y = net.p["b"] + net._run("f", x, mask, False)[0] @ net.p["of"] + net._run("b", x, mask, False)[0] @ net.p["ob"]
    q = np.exp(y) / np.exp(y).sum(axis=-1, keepdims=True)
    assert np.allclose(net.positions(x, mask), np.moveaxis(q, -1, 0), atol=1e-6)
    owner = np.repeat(np.arange(len(texts)), n)
    for k, t in enumerate(texts):
        at = [(w, j) for w in np.flatnonzero(owner == k) for j in range(langid.WINDOW) if mask[w, j]]
        assert len(at) == len(t)
        assert np.allclose(langid.pool(net, texts)[k], np.mean([q[j, w] for w, j in at], axis=0), atol=1e-5)


def test_language_of_held_out_documents(spark):
    got = langid.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).alias("p")
    both = got.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").where("held_out and lang is not null and length(text) >= 40").collect()
    assert len(both) > 100 and sum(r.lang == r.lang_pred for r in both) >= 0.97 * len(both)


def test_rare_languages_are_learned(spark):
    """A language is learned however many others there are."""
    data = [(k, "abc def " * 9 if k % 40 else "ϑϑϑ ϕϕϕ " * 9, f"l{k % 40:02}") for k in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = langid.identify(df, sample=5).collect()
    assert {r.lang_pred for r in got if r.doc_id % 40 == 0} == {"l00"}


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    both = quality.score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(both) > 50 and sum(r.predicted == r.quality for r in both) >= 0.95 * len(both)


def test_chat(spark):
    turns = [(1, 0, "system", "be nice"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 2, "ann", "again"), (1, 2, "ann", "again"), (1, None, None, "late"), (None, 0, "ann", "x"), (3, 0, "system", "alone")]
    df = spark.createDataFrame([(*t, 7) for t in turns], "conv_id long, turn long, role string, text string, part int")
    got = chat.rotate(df).collect()
    assert {(r.conv_id, r.perspective) for r in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    for c, p in {(r.conv_id, r.perspective) for r in got}:
        one = sorted((r for r in got if (r.conv_id, r.perspective) == (c, p)), key=lambda r: r.position)
        whole = "".join(r.segment for r in one)
        assert [r.position for r in one] == list(range(len(one))) and len(one) == sum(t[0] == c for t in turns)
        assert all(whole[r.start : r.stop] == r.segment for r in one) and one[-1].stop == len(whole)
        for r in one:
            own = whole[r.mask_start : r.mask_stop]
            assert r.trained == (r.speaker == p) and (own.endswith("<|end|>\n") if r.trained else own == "")
    assert all("hi < |end|>" in r.segment for r in got if r.position == 1 and r.conv_id == 1)
    assert chat.rotate(df.limit(0)).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    marked = ["<|endoftext|> hi", "a<|endoftext|>b <|startoftext|>", "x <|ENDOFTEXT|> y<|endoftext|>", "<|endoftext|><|endoftext|> \u0130 \u00df", "<|endoftext| > A<|EndOfText|>"]
    extra = [(300 + k, t, "en", "s1", 0, 1, "x", 2, "y", 3) for k, t in enumerate(marked)]
    got = packing.pack(docs.unionByName(docs.sparkSession.createDataFrame(extra, docs.schema)), with_ids=True, buffer_tokens=5000).collect()
    want = Counter((r[0], np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for r in [*rows(), *extra] if r[0] != 7)
    for d, ids in want:
        mine = sorted((r for r in got if r.doc_id == d), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in mine) == ids and all(r.doc_tokens == len(ids) // 4 for r in mine)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and 4 * r.length == len(r.ids) for r in got)
    seqs = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == seqs.get(r.sequence_id, 0)
        seqs[r.sequence_id] = r.offset + r.length
    assert all(n == 4096 or n & (n - 1) == 0 for n in seqs.values())
    assert packing.pack(none).count() == 0


def test_nnls():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, x = rng.random((12, 30)), np.maximum(0, rng.standard_normal(30))
        got = packing.nnls(a, a @ x)
        assert (got >= 0).all() and np.linalg.norm(a @ got - a @ x) < 1e-6
    assert all(sum(c) == packing.CLASSES and len(c) <= packing.DEPTH for c in packing.combinations())


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(20)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(none, labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_lines(spark, none):
    line = "A fairly long line of text that is repeated in several of the documents"
    data = [(1, f"{line}\n\nunique one here"), (2, line.lower() + "  \n" + line + "s!"), (3, None), (4, ""), (5, line + "\n" + line), (6, "ab\ncd\nab")]
    got = {(r.doc_id, r.line_no): r for r in linededup.line_dedup(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert len(got) == 11 and (3, 0) not in got
    for at in ((2, 0), (2, 1), (5, 0), (5, 1)):
        assert (got[at].keep_doc_id, got[at].keep_line_no, got[at].kept, got[at].group_size) == (1, 0, False, 5)
    assert got[1, 1].kept and got[4, 0].kept and got[1, 2].kept and got[6, 1].kept and not got[6, 2].kept
    df = spark.createDataFrame(data, "doc_id long, text string")
    cleaned = {r.doc_id: r.text for r in linededup.drop_lines(df, linededup.line_dedup(df)).collect()}
    assert cleaned[1] == data[0][1] and cleaned[2] == "" and cleaned[3] is None and cleaned[4] == "" and cleaned[6] == "ab\ncd"
    assert linededup.line_dedup(none).count() == 0


def test_simhash(docs, none):
    got = simhash.simhash_near_dedup(docs, words=4).collect()
    fp = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert len(got) == len(rows()) and fp[20] == fp[21] == fp[22] == 0
    ids = sorted(k for k in fp if k is not None)
    up = {k: k for k in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (fp[a] ^ fp[b]).bit_count() <= 4 and up[b] > up[a]:
                    up[b], changed = up[a], True
    assert all(r.component_id == up[r.doc_id] for r in got if r.doc_id is not None)
    assert simhash.simhash_near_dedup(none).count() == 0


def test_hamming_masks_cover():
    rng = np.random.default_rng(2)
    for within in (1, 2):
        masks = simhash.hamming_masks(within)
        for _ in range(200):
            x = int(rng.integers(0, 1 << 31))
            y = x
            for k in rng.choice(31, within, replace=False):
                y ^= 1 << int(k)

            def syndrome(v):
                s = 0
                for p in range(1, 32):
                    if v >> p - 1 & 1:
                        s ^= p
                return s

            home = [x ^ m for m in masks[syndrome(x)] if m.bit_count() <= 1]
            assert len(home) == 1 and syndrome(home[0]) == 0 and home[0] in {y ^ m for m in masks[syndrome(y)]}


def test_simhash_links_of_groups(spark):
    """Near copies in groups of many: components are those of all pairs of fingerprints."""
    rng = np.random.default_rng(8)
    data = []
    for size in (150, 80, *[4] * 60):
        base = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        for _ in range(size):
            words = list(base)
            words[int(rng.integers(150))] = f"n{rng.integers(0, 5000)}"
            data.append((len(data), " ".join(words)))
    got = simhash.simhash_near_dedup(spark.createDataFrame(data, "doc_id long, text string"), words=4).collect()
    fp = np.array([int(r.fingerprint, 16) for r in sorted(got)], np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= 4
    up = np.arange(len(fp))
    while (new := np.where(near, up[None], len(fp)).min(axis=1)).tolist() != up.tolist():
        up = new
    assert (np.unique(up, return_counts=True)[1] > 100).any() and len(np.unique(fp)) > len(np.unique(up)) + 50
    assert [r.component_id for r in sorted(got)] == up.tolist()


def test_fingerprints_follow_the_definition(docs):
    import re

    import xxhash

    got = {r.doc_id: r.fingerprint for r in simhash.simhash_near_dedup(docs, words=4).collect()}
    for r in rows():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        bits = sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))
        assert got[r[0]] == f"{bits:016x}"


def test_exact_copies_of_odd_ids(spark, none):
    """Null and repeated ids: copies go, unique texts stay."""
    data = [(None, "same text", 1), (None, "same text", 1), (None, "other text", 2), (5, "same  text", 3), (5, "a third text", 4), (5, "sametext", 5), (6, None, 6), (None, "", 7)]
    df = spark.createDataFrame(data, "doc_id long, text string, key int")
    got = sorted((r.text or "", r.doc_id or 0) for r in exactdedup.drop_copies(df).collect())
    assert got == [("", 6), ("a third text", 5), ("other text", 0), ("same  text", 5)]
    assert exactdedup.drop_copies(df).columns == df.columns and exactdedup.drop_copies(none).count() == 0


def test_near_copies_of_odd_ids(spark, none):
    base = [text(k, 200).split() for k in range(4)]
    near = [" ".join([*b[:-1], f"other{k}"]) for k, b in enumerate(base)]
    data = [(None, " ".join(base[0])), (3, near[0]), (3, " ".join(base[1])), (None, near[1]), (9, " ".join(base[2])), (9, near[2]), (None, " ".join(base[3])), (None, "")]
    df = spark.createDataFrame([(*r, k, "x") for k, r in enumerate(data)], "doc_id long, text string, id int, line string")
    kept = {r.id for r in simhash.drop_near(df).collect()}
    assert kept >= {1, 2, 6, 7} and len(kept & {4, 5}) == 1 and len(kept) == 5
    got = simhash.near_copies(df).collect()
    assert len(got) == len(data) and sum(r.kept for r in got) == 5
    assert simhash.drop_near(none).count() == 0 and simhash.drop_near(df).columns == df.columns


def test_near_copies(docs, none):
    got = {r.doc_id: r for r in simhash.near_copies(docs).collect()}
    assert got[24].component_id == 1 and not got[24].kept and got[25].component_id == 2 and got[21].component_id == 20
    assert simhash.near_copies(none).count() == 0


def test_lm(docs, none):
    got = {r.doc_id: r for r in ppm.lm_score(docs).collect()}
    assert got[20].n_tokens == got[21].n_tokens == got[22].n_tokens == 1 and got[20].score == got[22].score
    assert all(r.score < 0 and r.base_score < 0 and r.n_known <= r.n_tokens for r in got.values())
    assert ppm.lm_score(docs).count() == len(rows()) and ppm.lm_score(none).count() == 0
    alone = ppm.lm_score(docs.where("doc_id = 26"), folds=1).first()  # nothing to learn from
    assert alone.n_known == 0 and alone.train_tokens == 0 and alone.score == pytest.approx(-(len("é ü 日本 😀".encode()) + 1) * np.log10(256), rel=1e-3)


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 8))
    data = [(k, v.tolist()) for k, v in enumerate(base)] + [(100 + k, (v + 0.02 * rng.standard_normal(8)).tolist()) for k, v in enumerate(base[:20])]
    data += [(200, base[0].tolist()), (201, None), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [1.0] * 7 + [None]), (205, []), (206, [1.0, 2.0]), (207, [2.0, 4.0]), (None, base[1].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embeddings.near_embeddings(df, block=7).collect()}
    bad = {None, 201, 202, 203, 204, 205}
    good = [(k, np.float32(v).astype(float)) for k, v in data if k not in bad]
    unit = {k: v / np.linalg.norm(v) for k, v in good}
    for k, v in unit.items():
        near = [j for j, w in unit.items() if j != k and len(w) == len(v) and v @ w >= 0.9]
        assert got[k].n_links == len(near)
        assert all(got[j].component_id == got[k].component_id for j in near)
    assert all(got[k].n_links == 0 and got[k].component_id == k for k in bad)
    assert embeddings.near_embeddings(df.limit(0)).count() == 0


def chars(line):
    """The distinct six-character shingles of a line, as text."""
    text = line.decode() if isinstance(line, bytes) else line
    return frozenset(text[i : i + 6] for i in range(max(1, len(text) - 5)))


def roots(n, edges):
    uf = components.UnionFind()
    for a, b in edges:
        uf.union(a, b)
    return [uf.find(k) for k in range(n)]


def test_second_round_joins_what_brute_force_joins():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    words = [f"w{k}ab" for k in range(300)]
    lines = []
    for _ in range(4):
        base = list(rng.choice(words, 20))
        for _ in range(40):
            x = list(base)
            for _ in range(rng.integers(1, 3)):
                x[rng.integers(0, 20)] = words[rng.integers(0, 300)]
            lines.append(" ".join(x).encode())
    ids = list(range(len(lines)))
    comp = [k if k % 7 else max(0, k - 1) for k in ids]
    blocks = [(i, j) for i in range(3) for j in range(i, 3)]
    found = [(1, i, j, asks, k, comp[k], lines[k]) for i, j in blocks for asks, b in ((True, i), (False, j)) for k in ids if k % 3 == b]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], ["grp", "i", "j", "asks", "id", "comp", "line"])
    links = [p for o in minhash._compare(iter([batch]), 0.8, linededup.code_sets) for p in zip(o.column(0).to_pylist(), o.column(1).to_pylist(), strict=True)]
    sets = [chars(x) for x in lines]
    near = [(i, j) for i in ids for j in ids[:i] if minhash.jaccard(sets[i], sets[j]) >= 0.8]
    assert roots(len(ids), [*enumerate(comp), *links]) == roots(len(ids), [*enumerate(comp), *near])


def test_overlaps():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 9000, int(rng.integers(1, 6000)))) for _ in range(12)]
    a, b = np.arange(0, 7), np.arange(3, 12)
    got = minhash.overlaps(sets, a, b)
    assert all(got[i, k] == len(np.intersect1d(sets[i], sets[j])) for i in a for k, j in enumerate(b) if i != j)


def test_shingle_codes_tell_shingles_apart():
    lines = ["naïve café ab", "ab", "日本語のテキスト 123 日本語のテキスト", "😀😀😀😀😀😀😀x", "plain text, plain text", "éé", "ab\0\0\0\0c"]
    code, first = linededup.shingles([x.encode() for x in lines])
    every = [t for x in lines for t in ([x.ljust(6, "\0")] if len(x) < 6 else [x[i : i + 6] for i in range(len(x) - 5)])]
    assert len(code) == len(every) and dict(zip(every, code.tolist(), strict=True)) == {t: c for t, c in zip(every, code.tolist(), strict=True)}
    assert len(set(code.tolist())) == len(set(every)) and len(first) == len(lines)


def test_sorting_spills():
    rng = np.random.default_rng(9)
    blocks = [rng.integers(-50, 50, (200, 2)) for _ in range(40)]
    want = sorted({tuple(r) for x in blocks for r in x.tolist()})
    for most in (100, 3000, 10**6):
        got = [x for x in minhash._sorted(iter(blocks), most) if len(x)]
        assert sorted(tuple(r) for x in got for r in x.tolist()) == want and sum(map(len, got)) == len(want)
        bands = [set(x[:, 0].tolist()) for x in got]
        assert sum(map(len, bands)) == len(set().union(*bands))


def test_lines_equal_brute_force(spark):
    """Planted groups of similar lines of 12 to 40 characters, and all lines of a small table."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    lines = []
    for n in (12, 16, 20, 25, 30, 40):
        for _ in range(60):
            base = "".join(rng.choice(letters, n))
            cut = int(np.ceil(0.8 * (n - 5))) + 5
            lines += [base, base[:cut] if rng.random() < 0.5 else base[n - cut :]]
    sets = [chars(x) for x in lines]
    near = [(i, j) for i in range(len(lines)) for j in range(i) if minhash.jaccard(sets[i], sets[j]) >= 0.8]
    assert len(near) >= len(lines) // 2
    want = roots(len(lines), near)
    rows = [(k, x) for k, x in enumerate(lines)]
    got = {r.doc_id: r.keep_doc_id for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[k] == want[k] for k in got) >= 0.99 * len(lines)


def test_lines_of_odd_rows(spark):
    """Null ids, repeated rows, a very long line, clashing column names."""
    long = text(5, 40_000)
    data = [(None, "alpha beta gamma delta\nsecond"), (3, "alpha beta gamma delta"), (3, "alpha beta gamma delta"), (4, long + "\nshort"), (5, long + " more"), (6, "\t Alpha  beta gamma\tdelta\r\n\n")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in data], "doc_id long, text string, id int, line string, grp int")
    got = linededup.line_dedup(df).collect()
    at = {(r.doc_id, r.line_no): r for r in got}
    assert len(got) == 10 and at[None, 0].kept and at[3, 0].keep_doc_id is None and at[3, 0].group_size == 4 and not at[6, 0].kept
    assert (at[5, 0].keep_doc_id, at[5, 0].keep_line_no) == (4, 0) and at[4, 1].kept and at[6, 1].kept and at[6, 2].kept


def test_short_similar_lines_share_a_band():
    """Lines cut to a similarity of 0.80 to 0.85: of 5 to 40 shingles, hardly any pair is lost."""
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    for n in (5, 10, 14, 24, 40):
        k = int(np.ceil(0.8 * n))
        lines = ["".join(rng.choice(letters[:26], n + linededup.SHINGLE - 1)).encode() for _ in range(1000)]
        cut = [x[: k + linededup.SHINGLE - 1] for x in lines]
        assert all(minhash.jaccard(chars(x), chars(y)) >= 0.8 for x, y in zip(lines, cut, strict=True))
        assert (linededup.bands(lines) == linededup.bands(cut)).any(axis=1).mean() >= 0.99


def test_short_lines_are_joined(spark):
    rng = np.random.default_rng(6)
    lines = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 15)) for _ in range(200)]
    df = spark.createDataFrame([(2 * k + j, x[: 15 - 2 * j]) for k, x in enumerate(lines) for j in range(2)], "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.line_dedup(df).collect()}
    assert sum(got[2 * k + 1].keep_doc_id == 2 * k for k in range(200)) >= 198


def brute_ppm(learnt, text, order):
    """log10 probability of a text by PPM (method C, exclusion) over the counts of all contexts."""
    seen = {}
    for t in learnt:
        b = bytes([ppm.START]) * order + ppm.normal(t.encode()) + bytes([ppm.END])
        for i in range(order, len(b)):
            for j in range(order + 1):
                one = seen.setdefault(b[i - j : i], {})
                one[b[i]] = one.get(b[i], 0) + 1
    b = bytes([ppm.START]) * order + ppm.normal(text.encode()) + bytes([ppm.END])
    out = 0.0
    for i in range(order, len(b)):
        gone = set()
        for j in range(order, -1, -1):
            left = {k: n for k, n in seen.get(b[i - j : i], {}).items() if k not in gone}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if b[i] in left:
                out += np.log10(left[b[i]] / total)
                break
            out += np.log10(len(left) / total)
            gone |= set(left)
        else:
            out -= np.log10(max(1, 256 - len(seen.get(b"", {}))))
    return out


def test_lm_base_is_the_unigram_model(docs):
    """Tokens, known tokens, training tokens and the base score, by the plain formula."""
    learnt = [r for r in rows() if zlib.crc32(str(r[0]).encode()) % 10 != 0 or r[0] is None]
    got = {r.doc_id: r for r in ppm.lm_score(docs.where("doc_id IS NOT NULL"), hot_words=7).collect()}
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    count = Counter(w for r in learnt if r[0] is not None for w in tokens(r[1]))
    total = sum(count.values())
    for r in rows():
        if r[0] is None:
            continue
        g, mine = got[r[0]], tokens(r[1])
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(mine), sum(w in count for w in mine), total)
        assert g.held_out == (zlib.crc32(str(r[0]).encode()) % 10 == 0)
        assert g.base_score == pytest.approx(sum(np.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in mine), rel=1e-9)


@pytest.mark.parametrize("order", [0, 1, 2, 5])
def test_lm_keeps_all_counts(spark, order):
    """Neither the number of windows held in memory nor their counts change the scores."""
    from prismset.llm.common import id_hash

    data = [(k, text(k, 30) + f" rare{k * k}x") for k in range(60)] + [(100 + k, "aaaa " * 1500) for k in range(8)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    held = {r.doc_id for r in df.where(id_hash(df.doc_id) % 10 == 0).collect()}
    learnt = [t for k, t in data if k not in held]
    assert held and max(t.count("aaaa ") for t in learnt) * 5 > 4096  # such counts once changed the way sequences were chosen
    for hot in (0, 40, 1_000_000):
        got = {r.doc_id: r.score for r in ppm.lm_score(df, order=order, hot_codes=hot).collect()}
        for k, t in data[:65]:
            if k in held or k % 7 == 0:
                assert got[k] == pytest.approx(brute_ppm(learnt, t, order), rel=1e-4), (order, hot, k)
