"""Collocations, MinHash near-duplicates and source divergences against
brute-force versions, and the parts they are made of."""

import collections
import gc
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from evalspark.llm import collocations, divergence, minhash, queries
from evalspark.llm.shingles import Words, shingle_sets

from .conftest import SCHEMA, rows

LOWER = {c: c + 32 for c in range(65, 91)}


def frame(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, f"s{i % 3}") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").repartition(4)


# --- collocations -----------------------------------------------------------


def brute_phrases(docs, least, most, longest=4):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    candidates = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    held = collections.Counter()
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                held[lang, w[i : i + k]] = max(held[lang, w[i : i + k]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * held[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
            for i, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1)}


@pytest.mark.parametrize(("least", "part_mass"), [(3, 20_000), (30, 10**9)])
def test_collocations(spark, least, part_mass):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = collocations.collocations(docs, least=least, part_mass=part_mass).collect()
    assert {tuple(r) for r in got} == brute_phrases([(r[2], r[1]) for r in rows()], least, 2000)
    assert len(got) == len({(r["lang"], r["rank"]) for r in got})


def test_collocations_edges(spark):
    texts = ["a a a a, a a\ta"] * 5 + ["x y. z x y k x y", "X Y\rz", None, "", "..,", "é É é É"] * 4
    got = {tuple(r) for r in collocations.collocations(frame(spark, texts), least=2, most=3).collect()}
    assert got == brute_phrases([("en", t) for t in texts], 2, 3)
    nulls = frame(spark, texts, None)
    assert {r["lang"] for r in collocations.collocations(nulls, least=2).collect()} == {"und"}


def test_collocations_blocks_and_tasks(spark, monkeypatch):
    """Many small blocks, several hash partitions a task, ranks in several steps."""
    docs = frame(spark, [r[1] for r in rows()[:40]])
    whole = {tuple(r) for r in collocations.collocations(docs, least=4, most=7).collect()}
    for name, value in (("TASKS", 2), ("RANKED_ROWS", 20)):
        monkeypatch.setattr(collocations, name, value)
    assert {tuple(r) for r in collocations.collocations(docs, least=4, most=7, part_mass=2_000).collect()} == whole


def test_misra_gries_keeps_every_frequent_key():
    rng = np.random.default_rng(3)
    for _ in range(30):
        least, spare = int(rng.integers(2, 40)), int(rng.integers(1, 5))
        drawn = (rng.pareto(0.8, size=4000) * 20).astype(np.uint64) % np.uint64(3000)
        capacity = spare * len(drawn) // least + 1
        merged = collocations.MisraGries(capacity)
        for part in np.array_split(drawn, 7):
            own = collocations.MisraGries(capacity)
            for block in np.array_split(part, 3):
                own.merge(*np.unique(block, return_counts=True))
            merged.merge(own.keys, own.counts, own.taken)
        keys, counts = np.unique(drawn, return_counts=True)
        assert len(merged.keys) <= capacity and merged.taken * (capacity + 1) <= len(drawn)
        kept = merged.frequent(least)
        assert set(keys[counts >= least]) <= set(kept)
        low = dict(zip(merged.keys.tolist(), merged.counts.tolist(), strict=True))
        assert all(c - merged.taken <= low.get(k, 0) <= c for k, c in zip(keys.tolist(), counts.tolist(), strict=True))


def test_packed_counts():
    rng = np.random.default_rng(5)
    for bits in (24, 41, 64):
        keys = np.unique(rng.integers(0, 1 << (bits - 1), size=1000, dtype=np.uint64) * np.uint64(2))
        times = rng.integers(1, 600, size=len(keys)).astype(np.int64)
        back = collocations.unpacked(len(keys), collocations.packed(keys, times))
        assert (back[0] == keys).all() and (back[1] == times).all()
        starts = collocations._part_starts(7, bits)
        assert starts[0] == 0 and all(int(s) * 7 // (1 << bits) == i for i, s in enumerate(starts))


def sent(n_blocks, per_block, seed=11):
    """Messages of one hash partition, as ``_marked`` gets them, and the true counts."""
    rng = np.random.default_rng(seed)
    known, counts, out = np.unique(rng.integers(0, 1 << 40, size=400_000, dtype=np.uint64)), collections.Counter(), []
    for i in range(n_blocks):
        drawn = known[(rng.random(per_block) ** 4 * len(known)).astype(np.int64)]
        keys, times = np.unique(drawn, return_counts=True)
        counts.update(dict(zip(keys.tolist(), times.tolist(), strict=True)))
        out.append((0, f"b{i}", len(keys), collocations.packed(keys, times.astype(np.int64)), keys))
    return out, counts


class Asked:
    """Stands in for a table whose rows one task gets."""

    def mapInArrow(self, run, schema):
        return run


def peak_of(work):
    gc.collect()
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("least", [3, 30, 10**6])
def test_marked_memory_and_answers(least):
    """A task's memory is a few times the digests sent to it, and every digest
    with ``least`` occurrences is marked."""
    messages, counts = sent(60, 30_000)
    entries = sum(m[2] for m in messages)
    batch = pa.RecordBatch.from_arrays([pa.array([m[0] for m in messages], pa.int32()), pa.array([m[1] for m in messages]),
                                        pa.array([m[2] for m in messages], pa.int32()), pa.array([m[3] for m in messages], pa.binary())],
                                       ["part", "block", "n", "data"])
    run = collocations._marked(Asked(), least)
    out, peak = peak_of(lambda: [tuple(row.values()) for b in run(iter([batch])) for row in b.to_pylist()])
    assert peak < 48 * entries
    assert [r[:3] for r in out] == [(m[1], 0, m[2]) for m in messages]
    for (*_, keys), (*_, n, mask) in zip(messages, out, strict=True):
        bits = np.unpackbits(np.frombuffer(mask, dtype=np.uint8), count=n).astype(bool)
        frequent = np.array([counts[k] >= least for k in keys.tolist()])
        assert bits[frequent].all()
        if least == 10**6:
            assert not bits.any()


def test_block_memory_and_counts():
    """Counting the marked n-grams of a block takes a bounded number of bytes each."""
    rng = np.random.default_rng(2)
    words = [b"w%d" % i for i in range(20_000)]
    tokens = (rng.random(200_000) ** 3 * len(words)).astype("<u4") + np.uint32(1)
    tokens[rng.random(len(tokens)) < 0.05] = 0
    tokens[-1] = 0
    stored = (["en"], np.array([len(tokens)], dtype="<u4").tobytes(), b"\n".join([b".", *words]), tokens.tobytes())
    plain = collocations._Block(*stored, 4, 40, False)

    def work():
        block = collocations._Block(*stored, 4, 40, True)
        assert (block.keys == plain.keys).all()
        return [(r["words"], r["phrase"], r["n"]) for b in block.marked(plain.times >= 3) for r in b.to_pylist()]

    def memory():
        return sum(b.num_rows for b in collocations._Block(*stored, 4, 40, True).marked(plain.times >= 3))

    assert peak_of(memory)[1] < 48 * int(plain.times.sum())
    expected = collections.Counter()
    for piece in " ".join("." if t == 0 else f"w{t - 1}" for t in tokens.tolist()).split("."):
        ws = piece.split()
        for k in range(1, 5):
            expected.update((k, " ".join(ws[i : i + k])) for i in range(len(ws) - k + 1))
    assert sorted(work()) == sorted((k, g, n) for (k, g), n in expected.items() if n >= 3)


# --- near duplicates --------------------------------------------------------


def sets_of(docs, k):
    out = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute_components(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_minhash_on_the_odd_table(spark, odd, docs):
    got = queries.QUERIES["op12_minhash_dedup"](spark, odd).collect()
    assert len(got) == len(docs)
    with_id = [(i, t) for i, t in docs if i is not None]
    sets = sets_of(with_id, 4)
    want = brute_components(sets, 80)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    # rows without an id: a copy is in the component of its text, the others stand alone and stay
    assert sorted((r.component_id, r.kept) for r in got if r.doc_id is None and r.component_id is not None) == [(5, False)]
    assert sum(r.kept for r in got if r.doc_id is None) == 2


def edited(rng, words, share):
    out = list(words)
    for i in rng.choice(len(out), size=max(1, int(share * len(out))), replace=False):
        out[i] = f"e{rng.integers(1 << 30)}"
    return " ".join(out)


@pytest.mark.parametrize("tile", [4, 2000])
def test_minhash_hard_groups(spark, monkeypatch, tile):
    """A large group of near copies about the threshold, chains, a passage that
    many documents share, documents of one to five words."""
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "DOC_TILE", tile)
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(200)]
    texts = [edited(rng, base, s) for s in rng.choice([0.01, 0.02, 0.03, 0.05], size=60)]
    chain = [f"c{i}" for i in range(120)]
    for i in range(8):
        texts.append(" ".join(chain[4 * i : 4 * i + 70]))
    texts += [" ".join(base[:50]) + " " + " ".join(f"p{rng.integers(1 << 30)}" for _ in range(20)) for _ in range(40)]
    texts += ["one", "One", "one two", "one two three four", "one two three four five", "", None]
    docs = list(enumerate(texts))
    got = {r.id: (r.component_id, r.n_shingles) for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    sets = sets_of(docs, 4)
    want = brute_components(sets, 80)
    assert got == {i: (want[i], len(sets[i])) for i in sets}


def test_sketches_fill_and_follow_the_similarity():
    rng = np.random.default_rng(2)
    words = Words()
    for text in ("a", "a b c d e", "a b c d e f g"):
        made = minhash.sketch(next(shingle_sets([text], 4, words)))
        assert made.shape == (minhash.SIZE,) and len(set(made.tolist())) > 50
    for n in (3, 10, 100, 3000):
        errors = []
        for _ in range(40):
            shared = rng.integers(0, 1 << 62, size=n, dtype=np.uint64)
            a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 62, size=max(1, n // 4), dtype=np.uint64)])) for _ in range(2))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((minhash.sketch(a) == minhash.sketch(b)).mean() - true)
            assert (minhash.sketch(a) == minhash.sketch(a[::-1])).all()
        assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 5 * 0.03


def test_first_shared_band_only_and_least_equal():
    s = np.zeros((2, minhash.SIZE), dtype=np.uint8)
    keys = minhash.band_keys(s)
    assert (keys[0] == keys[1]).all() and len(set(keys[0].tolist())) == minhash.BANDS
    assert 0.67 * minhash.SIZE < minhash.least_equal(80) < 0.8 * minhash.SIZE


# --- divergences ------------------------------------------------------------


def brute_divergences(docs, least_docs, most):
    lists = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for lang, source, text in docs]
    in_docs, counts, groups = collections.Counter(), collections.Counter(), sorted({d[:2] for d in lists})
    for lang, source, terms in lists:
        in_docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    kept = collections.defaultdict(list)
    for (lang, t), k in in_docs.items():
        if k >= least_docs:
            kept[lang].append(t)
    out = set()
    for lang in {g[0] for g in groups}:
        own, terms = [s for g, s in groups if g == lang], kept[lang]
        n = {s: sum(counts[lang, s, t] for t in terms) for s in own}
        whole, v = sum(n.values()), len(terms)
        p = {s: {t: 1 + 10**9 * (counts[lang, s, t] + 1) // (n[s] + v) for t in terms} for s in own}
        q = {t: 1 + 10**9 * (sum(counts[lang, s, t] for s in own) + 1) // (whole + v) for t in terms}
        for s in own:
            pairs = sorted((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in terms), o.encode()) for o in own if o != s)
            out |= {(lang, s, "pair", o.decode(), -f, i) for i, (f, o) in enumerate(pairs, 1)}
            found = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in terms if counts[lang, s, t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t.decode(), -f, i) for i, (f, t) in enumerate(found[:most], 1)}
    return out


@pytest.mark.parametrize("most", [200, 5])
def test_divergences(spark, monkeypatch, most):
    monkeypatch.setattr(divergence, "PAIR_BLOCK", 7 if most == 5 else 1_000_000)
    docs = rows()[:75] + [(900 + i, "only_here Straße ÄÖ12ÄÖ x" if i < 4 else None, "fr" if i % 2 else None, f"t{i}") + rows()[0][4:] for i in range(6)]
    got = [tuple(r) for r in divergence.divergences(spark.createDataFrame(docs, SCHEMA).repartition(5), most_terms=most).collect()]
    assert set(got) == brute_divergences([(r[2], r[3], r[1]) for r in docs], 3, most) and len(got) == len(set(got))


def test_divergences_of_the_odd_table(spark, odd):
    got = {tuple(r) for r in queries.QUERIES["op13_source_divergence"](spark, odd).collect()}
    assert got == brute_divergences([(r[2], r[3], r[1]) for r in rows()], 3, 200)


def test_partial_counts_are_sent_on_when_many(spark, monkeypatch):
    docs = frame(spark, [r[1] for r in rows()[:60]])
    whole = {tuple(r) for r in divergence.divergences(docs).collect()}
    monkeypatch.setattr(divergence, "HELD_ROWS", 50)
    monkeypatch.setattr(divergence, "TEXT_SLICE", 300)
    assert {tuple(r) for r in divergence.divergences(docs).collect()} == whole
