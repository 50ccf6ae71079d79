"""Every query on the odd table (against a brute-force version) and on an empty one."""

import collections
import hashlib
import math
import re
import zlib

import pytest

from evalspark.llm import decontam, fingerprint, packing, queries


def collect(spark, name, folder):
    return queries.QUERIES[name](spark, folder).collect()


def multiset(rows):
    return collections.Counter(rows)


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, empty, name):
    assert collect(spark, name, empty) == []


def test_language_id(spark, odd, docs):
    got = collect(spark, "op1_language_id", odd)
    assert len(got) == len(docs)
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        assert r.held_out == (crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1
    for i, text in docs:
        letters = any(c.isalpha() for c in text or "")
        assert all((r.lang_pred == "und") == (not letters) for r in by[i] if i is not None)
    right = [r.lang_pred == ("en" if r.doc_id % 3 else "de") for r in got if r.doc_id is not None and r.doc_id < 60]
    assert sum(right) >= 57


def brute_spans(text):
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
             ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for rank, (kind, pattern) in enumerate(kinds):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_pii(spark, odd, docs):
    got = collect(spark, "op2_pii", odd)
    want = multiset((i, hashlib.sha256(brute_spans(t).encode()).hexdigest()) for i, t in docs)
    assert multiset((r.doc_id, r.base_sha256) for r in got) == want
    row = next(r for r in got if r.doc_id == 130)
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)


def test_packing(spark, odd, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.public_vocabulary()["tokenizer_path"])
    got = collect(spark, "op3_best_fit_packing", odd)
    want = collections.Counter()
    for i, t in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        edge, start, piece = len(ids) % 1024 or 1024, 0, 0
        while start < len(ids):
            data = b"".join(x.to_bytes(4, "little") for x in ids[start:edge])
            want[i, piece, start, edge - start, zlib.crc32(data)] += 1
            start, edge, piece = edge, edge + 1024, piece + 1
    assert multiset((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 1024) + 1


def test_fingerprint(spark, odd, docs):
    got = collect(spark, "op4_fingerprint", odd)
    order = sorted(((i, t or "") for i, t in docs), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = collections.Counter()

    def alike(a, b):
        a, b = set(fingerprint.digests(a).tolist()), set(fingerprint.digests(b).tolist())
        return round(len(a & b) / len(a | b) if a | b else 1.0, 9)

    for (i, t), (_, x) in zip(order, order[1:] + order[:1], strict=True):
        k = len(t) // 3
        e = t[: len(t) - k] + x[:k]
        want[i, len(t), hashlib.sha256(e.encode()).hexdigest(), alike(t, e), alike(t, x)] += 1
    assert multiset((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    prints = {}
    for r in got:
        if r.doc_id is not None:
            prints[r.doc_id] = r.fingerprint
    assert prints[100] == prints[101] == prints[5] != prints[102]


def test_quality(spark, odd, docs):
    got = collect(spark, "op5_quality", odd)
    assert multiset(r.doc_id for r in got) == multiset(i for i, _ in docs)
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def brute_edits(item, words):
    best, row = len(item), list(range(len(item) + 1))
    for w in words:
        new = [0]
        for j, x in enumerate(item):
            new.append(min(row[j] + (x != w), row[j + 1] + 1, new[j] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_decontamination(spark, odd, docs):
    from .conftest import ITEMS

    got = collect(spark, "op6_decontamination", odd)
    want = collections.Counter()
    for i, t in docs:
        words = decontam.words_of(t)
        for item, text in ITEMS:
            own = decontam.words_of(text)
            if own and len(words) < 5000:
                e = brute_edits(own, words)
                if e <= decontam.most_edits(len(own), 75):
                    want[i, item, len(own), e] += 1
    assert multiset((r.doc_id, r.item_id, r.n_words, r.edits) for r in got) == want and want


def test_suffixes(spark, odd, docs):
    got = collect(spark, "op7_suffix_dedup", odd)
    data = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in data:
        if i is not None:
            for s in {b[p : p + 50] for p in range(len(b) - 49)}:
                first[s] = min(i, first.get(s, i))
    want = collections.Counter()
    for i, b in data:
        cut = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - 49):
                if first[b[p : p + 50]] < i:
                    cut[p : p + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(cut)))
        kept = bytes(x for x, c in zip(b, cut, strict=True) if not c)
        want[i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert multiset((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_jaccard(spark, odd, docs):
    got = collect(spark, "op8_jaccard_join", odd)
    sets = [(i, shingles(t)) for i, t in docs]
    named = [s for s in sets if s[0] is not None]
    root = {i: i for i, _ in named}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(named):
        for j, b in named[:x]:
            if a and 100 * len(a & b) >= 75 * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    want = collections.Counter()
    for i, s in sets:
        same = [find(j) for j, o in named if s and o == s]
        want[i, len(s), find(i) if i is not None else (same[0] if same else None)] += 1
    assert multiset((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    by = {r.doc_id: r.component_id for r in got}
    assert by[102] == by[103] == by[100] == 5 and by[116] == 115 and by[110] == 110


def test_licenses(spark, odd, docs):
    got = collect(spark, "op9_license_scan", odd)
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by[131].license, by[131].origin) == ("MIT", "own") and by[1000].license == "Apache-2.0"
    assert by[110].license is None or by[110].origin == "inherited"


def test_lm(spark, odd, docs):
    got = collect(spark, "op10_lm_scoring", odd)
    tokens = [(i, [*(t or "").encode().lower().split(), "end"]) for i, t in docs]
    one, two, ctx = collections.Counter(), collections.Counter(), collections.Counter()
    for i, x in tokens:
        if crc(i) % 5 != 1:
            before = ["start", *x[:-1]]
            one.update(x)
            ctx.update(before)
            two.update(zip(before, x, strict=True))
    n = sum(one.values())
    whole = n + 0.5 * (len(one) + 1)
    want = collections.defaultdict(list)
    for i, x in tokens:
        base = sum(math.log10((one[w] + 0.5) / whole) for w in x)
        score = sum(math.log10(two[u, w] / (ctx[u] + 20) + 20 / (ctx[u] + 20) * (one[w] + 0.5) / whole)
                    for u, w in zip(["start", *x[:-1]], x, strict=True))
        want[i].append((crc(i) % 5 == 1, len(x), sum(one[w] > 0 for w in x), n, base, score))
    have = collections.defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert have.keys() == want.keys()
    for i in want:
        for a, b in zip(sorted(have[i]), sorted(want[i]), strict=True):
            assert a[:4] == b[:4] and a[4] == pytest.approx(b[4]) and a[5] == pytest.approx(b[5], rel=2e-3)
