"""Language identification and licence scans against plain versions written
from their stated rules; quality by held-out accuracy."""

import collections
import math
import re
import zlib

import pytest

from evalspark.llm import licenses, queries

TABLES = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())


def table(spark, folder, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*columns).collect()]


# --- language identification ------------------------------------------------


def letters_of(text):
    return [w for w in re.findall(r"[^\W\d_]+", text.lower()) if any(c.isalpha() for c in w)]


def pieces(word, size):
    padded = word if size == 1 else f"^{word}$"
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


class BruteLanguages:
    """Every word by its log frequency, an unseen one by the mean of its longest known n-grams."""

    def __init__(self, rows, max_words=60_000, max_grams=80_000, alpha=0.5):
        counts = collections.defaultdict(collections.Counter)
        for text, lang in rows:
            for word in letters_of(text):
                counts[lang, 0][word] += 1
                for size in range(1, 6):
                    counts[lang, size].update(pieces(word, size))
        self.langs = sorted({lang for lang, _ in counts})
        share = collections.defaultdict(float)
        for (_, kind), own in counts.items():
            whole = sum(own.values())
            for item, n in own.items():
                share[kind, item] = max(share[kind, item], n / whole)
        ranked = sorted(share, key=lambda k: (-share[k], k))
        chosen = [k for k in ranked if k[0] == 0][:max_words] + [k for k in ranked if k[0]][:max_grams]
        size = {k: (sum(c.values()), len(c)) for k, c in counts.items()}
        self.logs = {}
        for kind, item in chosen:
            self.logs[kind, item] = [
                math.log((counts[lang, kind][item] + alpha) / (size.get((lang, kind), (0, 0))[0] + alpha * (size.get((lang, kind), (0, 0))[1] + 1)))
                for lang in self.langs]

    def vector(self, word):
        if (0, word) in self.logs:
            return self.logs[0, word]
        for size in (5, 4, 3, 2, 1):
            known = [self.logs[size, g] for g in pieces(word, size) if (size, g) in self.logs]
            if known:
                return [sum(x) / len(known) for x in zip(*known, strict=True)]
        return [0.0] * len(self.langs)

    def score(self, text):
        words = letters_of(text or "")
        if not words:
            return "und", 0.0
        total = [sum(x) for x in zip(*map(self.vector, words), strict=True)]
        best = max(total)
        odds = [math.exp((t - best) / math.sqrt(len(words))) for t in total]
        return self.langs[total.index(best)], 1 / sum(odds)


@pytest.mark.parametrize("folder", ["odd", TABLES])
def test_languages(spark, odd, folder):
    folder = odd if folder == "odd" else folder
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    model = BruteLanguages([(t, lang) for i, t, lang in docs if crc(i) % 5 and t is not None and lang is not None])
    want = collections.defaultdict(list)
    for i, text, _ in docs:
        want[i].append((*model.score(text),))
    got = collections.defaultdict(list)
    for r in queries.QUERIES["op1_language_id"](spark, folder).collect():
        got[r.doc_id].append((r.lang_pred, r.score))
    assert got.keys() == want.keys()
    for i in want:
        for a, b in zip(sorted(got[i]), sorted(want[i]), strict=True):
            assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-3), i


# --- licence scans ----------------------------------------------------------


def licence_words(line):
    plain = re.sub(r"(?<=[0-9])(?:\.0)+(?![0-9]|\.[0-9])", "", line.lower().replace("licence", "license"))
    return re.findall(r"[a-z]+|[0-9]+(?:\.[0-9]+)*", plain)


class BruteLicences:
    def __init__(self, templates, least=0.7):
        self.least = least
        self.texts = sorted({(name, tuple(licence_words(t))) for name, given in templates.items() for t in given})
        n = len(self.texts)
        held = collections.Counter(w for _, words in self.texts for w in set(words))
        self.idf = {w: math.log((n + 1) / (k + 1)) + 1 for w, k in held.items()}
        self.other = math.log(n + 1) + 1

    def weights(self, words):
        return {w: k * self.idf.get(w, self.other) for w, k in collections.Counter(words).items()}

    def cosine(self, a, b):
        a, b = self.weights(a), self.weights(b)
        return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    def statements(self, text):
        """(line, licence, score): the best per line in which a passage begins."""
        if text is None or not re.search(licenses.MARK, text):
            return []
        words = [(w, at) for at, line in enumerate(text.split("\n")) for w in licence_words(line)]
        found = {}
        for name, template in self.texts:
            rare = [w for w in dict.fromkeys(template) if w not in licenses.COMMON and not w[0].isdigit()] or list(dict.fromkeys(template))
            for seed in sorted(rare, key=lambda w: (-self.idf[w], -len(w), w))[:2]:
                for i, (word, _) in enumerate(words):
                    if word != seed:
                        continue
                    window = words[max(0, i - template.index(seed)) : i - template.index(seed) + len(template)]
                    held = {w for w, _ in window}
                    needs = {w for w in template if w[0].isdigit() or w in licenses.APART}
                    if needs - held or (held & set(licenses.APART)) - needs:
                        continue
                    score = round(self.cosine([w for w, _ in window], template), 6)
                    if score >= self.least:
                        at = window[0][1]
                        found[at] = min(found.get(at, (0, "")), (-score, name))
        return [(at, name, -s) for at, (s, name) in found.items()]

    def scan(self, files):
        """(path, text) rows -> (license, score, origin, from_path) a row."""
        best = {}
        for path, text in files:
            for at, name, score in self.statements(text) if path is not None else []:
                best[path, at] = min(best.get((path, at), (0, "")), (-score, name))
        own, given = {}, {}
        for (path, at), (score, name) in best.items():
            speaks = bool(re.search(licenses.LICENCE_FILE, path))
            early = at if speaks else 0
            own[path] = min(own.get(path, (1,)), (score, early, name, at))
            if speaks or at == 0:
                above = path.rpartition("/")[0]
                given[above] = min(given.get(above, (1,)), (score, early, name, path))
        out = []
        for path, _ in files:
            if path in own:
                out.append((own[path][2], -own[path][0], "own", path))
                continue
            above = None if path is None else path.rpartition("/")[0]
            while above and above not in given:
                above = above.rpartition("/")[0]
            if above is not None and above in given:
                out.append((given[above][2], -given[above][0], "inherited", given[above][3]))
            else:
                out.append((None, None, "none", None))
        return out


def laid_out(i, source):
    if i is None:
        return None
    return "/".join([*([source] if source is not None else []), *([str(i // 1000)] if i % 1000 else []), *([str(i // 100)] if i % 100 else []), str(i)])


@pytest.mark.parametrize("folder", ["odd", TABLES])
def test_licences(spark, odd, folder):
    folder = odd if folder == "odd" else folder
    docs = table(spark, folder, "documents", "doc_id", "source", "text")
    files = [(laid_out(i, source), text) for i, source, text in docs]
    want = collections.Counter()
    for (i, _, _), (name, score, origin, path) in zip(docs, BruteLicences(licenses.ALL_TEMPLATES).scan(files), strict=True):
        want[i, name, None if score is None else round(score, 5), origin, None if path is None else int(path.rpartition("/")[2])] += 1
    got = collections.Counter((r.doc_id, r.license, None if r.score is None else round(r.score, 5), r.origin, r.from_doc_id)
                              for r in queries.QUERIES["op9_license_scan"](spark, folder).collect())
    assert got == want


# --- quality ----------------------------------------------------------------


def test_quality_of_held_out_rows(spark):
    labels = {i: q for i, q in table(spark, TABLES, "labels", "doc_id", "quality") if i is not None and q is not None}
    scored = [(r.score, labels[r.doc_id]) for r in queries.QUERIES["op5_quality"](spark, TABLES).collect() if r.held_out and r.doc_id in labels]
    good, bad = [s for s, q in scored if q == 1], [s for s, q in scored if q == 0]
    assert len(good) >= 10 and len(bad) >= 10
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert above >= 0.95 * len(good) * len(bad)
