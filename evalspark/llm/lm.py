"""Language-model scoring with an Elias-Fano n-gram trie.

A bigram model with Dirichlet smoothing, learned from the training documents
and asked for every token of every document:

    p(w | u) = c(u w) / (c(u) + mu)  +  mu / (c(u) + mu) * p(w)
    p(w)     = (c(w) + 1/2) / (N + (V + 1) / 2)

1. One pass turns texts into blocks: the block's distinct words, their
   training counts and the tokens as word numbers; written once.
2. Every block sends each distinct word and each distinct pair once, with its
   training count, to a part: words by their digest, pairs by their context,
   or by context and word where the context is hot (a share of the tokens
   above 1 / (4 parts), so there are at most 4 parts of them; their exact
   counts are gathered first). A word that makes up any share of the corpus
   therefore costs one entry per block and word pair, spread over the parts.
3. Each part adds the counts and builds its shard of the trie: contexts with
   quantised backoff weights, monotone pointers to their successors, and
   successors with quantised smoothed probabilities, all Elias-Fano coded,
   saved and memory-mapped. Its blocks' pairs are looked up there by
   context-relative successor search, and the codes go back to the blocks.
4. Each block adds up its documents.

Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end per
document. Defined cases: NULL text is the empty text, which is one end; with
no training document every token is unknown; repeated rows are each learned
and scored; NULL ids keep their row; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .eliasfano import BigramTrie
from .shingles import mix, words_of

BLOCK_BYTES = 6_000_000
TEXT_SLICE = 1_000_000
END, START = 0, 1  # word numbers in every block
SPECIAL = np.array([0x9D39247E33776D41, 0x2AF7398005AAA5C7], dtype=np.uint64)
WORDS, PAIRS, TOTALS, BLOCK = range(4)
LOW48 = np.uint64((1 << 48) - 1)
STEP = 4096  # quantisation: codes are -log10 in steps of 1 / STEP
DEALT = "part int, block string, kind byte, n int, packed binary"


def quantised(p: np.ndarray) -> np.ndarray:
    """Probabilities as codes 1 to 65535; 0 stays 0."""
    code = np.clip(np.rint(-np.log10(np.maximum(p, 1e-300)) * STEP) + 1, 1, 65535)
    return np.where(p > 0, code, 0).astype(np.uint16)


def probability(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) / STEP), 0.0)


def narrow(numbers: np.ndarray, below: int) -> bytes:
    """Word numbers in three bytes each where that is enough, else in four."""
    wide = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4)
    return wide[:, : 3 if below <= 1 << 24 else 4].tobytes()


def widened(packed: bytes, n: int) -> np.ndarray:
    wide = np.zeros((n, 4), dtype=np.uint8)
    width = len(packed) // n
    wide[:, :width] = np.frombuffer(packed, dtype=np.uint8).reshape(n, width)
    return wide.view("<u4").ravel()


# --- step 1: blocks ---------------------------------------------------------


def blocks(rows: DataFrame) -> DataFrame:
    """rows: id, train, text. One row per block of documents."""
    def finish(held: list[tuple], numbers: dict[bytes, int], tokens: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(tokens)
        digests = np.empty(len(numbers) + 2, dtype=np.uint64)
        digests[:2] = SPECIAL
        digests[2:] = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), dtype=np.uint64, count=len(numbers))
        lengths = np.array([h[2] for h in held], dtype="<u4")
        train = np.array([h[1] for h in held], dtype=bool)
        counts = np.bincount(flat[np.repeat(train, lengths)], minlength=len(digests)).astype("<u4")
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
             pa.array([np.packbits(train).tobytes()]), pa.array([lengths.tobytes()]), pa.array([digests.astype("<u8").tobytes()]),
             pa.array([counts.tobytes()]), pa.array([narrow(flat, len(digests))]), pa.array([int(train.sum())], pa.int64()),
             pa.array([len(flat)], pa.int64())], names)

    names = ["block", "ids", "train", "lengths", "digests", "counts", "tokens", "n_train", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, numbers, tokens, size = [], {}, [], 0
        for batch in batches:
            ids, train = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for lo, hi in common.slices(texts, TEXT_SLICE):
                lists = [words_of(t) for t in texts[lo:hi]]
                for words in lists:
                    for w in set(words):
                        if w not in numbers:
                            numbers[w] = len(numbers) + 2
                    own = np.zeros(len(words) + 1, dtype=np.uint32)
                    own[:-1] = np.fromiter(map(numbers.__getitem__, words), dtype=np.uint32, count=len(words))
                    tokens.append(own)
                held += zip(ids[lo:hi], train[lo:hi], [len(x) + 1 for x in lists], strict=True)
                size += sum(map(len, texts[lo:hi]))
                if size >= BLOCK_BYTES:
                    yield finish(held, numbers, tokens)
                    held, numbers, tokens, size = [], {}, [], 0
        if held:
            yield finish(held, numbers, tokens)

    common.ship(rows.sparkSession)
    return rows.select("id", "train", "text").mapInArrow(
        run, "block string, ids array<long>, train binary, lengths binary, digests binary, counts binary, tokens binary, n_train long, n_tokens long")


def _hot(stored: DataFrame, n_tokens: int, n_train: int, parts: int) -> dict[int, int]:
    """Training counts of the words above a share of 1 / (4 parts); a word
    with that share of all tokens has it in some block. START is always hot."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digests, counts in common.rows_of(batch):
                counts = np.frombuffer(counts, dtype="<u4")
                some = np.flatnonzero(counts * np.float64(4 * parts) >= max(1, counts.sum()))
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(digests, dtype="<i8")[some])], ["digest"])

    least = max(1, n_tokens // (4 * parts))
    some = stored.select("digests", "counts").mapInArrow(over, "digest long").distinct()
    candidates = {r[0] for r in some.collect()} if n_tokens else set()
    wanted = np.array(sorted(candidates), dtype=np.int64)
    shared = stored.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for digests, counts in common.rows_of(batch):
                d = np.frombuffer(digests, dtype="<i8")
                at = np.searchsorted(shared.value, d)
                hit = np.flatnonzero((at < len(shared.value)) & (shared.value[np.minimum(at, len(shared.value) - 1)] == d))
                np.add.at(total, at[hit], np.frombuffer(counts, dtype="<u4")[hit].astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(shared.value), pa.array(total)], ["digest", "n"])

    found = {}
    if len(wanted):
        summed = stored.select("digests", "counts").mapInArrow(count, "digest long, n long").groupBy("digest").agg(F.sum("n").alias("n"))
        found = {r["digest"]: r["n"] for r in summed.where(F.col("n") >= least).collect()}
    found.pop(int(SPECIAL[END].astype(np.int64)), None)
    return found | {int(SPECIAL[START].astype(np.int64)): n_train}


# --- step 2: what a block sends, in an order it can find again --------------


class _Block:
    def __init__(self, train: bytes, lengths: bytes, digests: bytes, counts: bytes, tokens: bytes, parts: int, hot: np.ndarray):
        self.digests = np.frombuffer(digests, dtype="<u8")
        self.counts = np.frombuffer(counts, dtype="<u4")
        self.lengths = np.frombuffer(lengths, dtype="<u4").astype(np.int64)
        self.tokens = widened(tokens, int(self.lengths.sum()))
        train_of = np.unpackbits(np.frombuffer(train, dtype=np.uint8), count=len(self.lengths)).astype(bool)
        self.first = np.cumsum(self.lengths) - self.lengths
        context = np.empty(len(self.tokens), dtype=np.uint32)
        context[1:] = self.tokens[:-1]
        context[self.first] = START
        k = len(self.digests)
        code, self.pair_of, times = np.unique(context.astype(np.int64) * k + self.tokens, return_inverse=True, return_counts=True)
        learned = np.repeat(train_of, self.lengths)
        times = times if learned.all() else np.bincount(self.pair_of, weights=learned, minlength=len(code)).astype(np.int64)
        u, w = code // k, code % k
        is_hot = np.isin(self.digests.view(np.int64), hot)
        own = mix(self.digests)
        part = np.where(is_hot[u], mix(own[u] + self.digests[w]), own[u]) % np.uint64(parts)
        low = mix(self.digests ^ SPECIAL[0]) & LOW48
        order = np.lexsort((low[w], self.digests[u], part))
        self.pair_order, self.pair_part = order, part[order].astype(np.int64)
        self.u, self.w, self.low, self.times = u.astype(np.uint32), w.astype(np.uint32), low, times.astype(np.uint32)
        word_part = (own % np.uint64(parts)).astype(np.int64)
        word_part[START] = -1  # never a token
        self.word_order = np.argsort(word_part, kind="stable")[1:]
        self.word_part = word_part[self.word_order]

    @staticmethod
    def _edges(part: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.diff(part, prepend=-1))

    def messages(self) -> Iterator[tuple[int, int, int, bytes]]:
        edges = self._edges(self.word_part)
        for p, some in zip(self.word_part[edges], np.split(self.word_order, edges[1:]), strict=True):
            yield int(p), WORDS, len(some), self.digests[some].tobytes() + self.counts[some].tobytes()
        edges = self._edges(self.pair_part)
        for p, some in zip(self.pair_part[edges], np.split(self.pair_order, edges[1:]), strict=True):
            context = self.digests[self.u[some]]
            begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            low, times = self.low[self.w[some]], self.times[some]
            large = np.flatnonzero(times >= 255)
            yield int(p), PAIRS, len(some), b"".join([
                np.array([len(begin), len(large)], dtype="<u4").tobytes(), context[begin].astype("<u8").tobytes(),
                np.diff(begin, append=len(some)).astype("<u4").tobytes(), low.astype("<u4").tobytes(),
                (low >> np.uint64(32)).astype("<u2").tobytes(), np.minimum(times, 255).astype("u1").tobytes(),
                large.astype("<u4").tobytes(), times[large].astype("<u4").tobytes()])

    def replies(self, words: dict[int, bytes], pairs: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Training count per word; probability and backoff weight per pair."""
        count = np.zeros(len(self.digests), dtype=np.int64)
        count[self.word_order] = np.concatenate([np.frombuffer(words[p], dtype="<i8") for p in np.unique(self.word_part).tolist()])
        both = [np.frombuffer(pairs[p], dtype="<u2").reshape(2, -1) for p in np.unique(self.pair_part).tolist()]
        codes = np.empty((2, len(self.pair_order)), dtype=np.uint16)
        codes[:, self.pair_order] = np.concatenate(both, axis=1)
        return count, probability(codes[0]), probability(codes[1])


def _unpacked_pairs(n: int, packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n_contexts, n_large = np.frombuffer(packed, dtype="<u4", count=2).tolist()
    at = 8

    def take(kind: str, k: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(packed, dtype=kind, count=k, offset=at)
        at += out.nbytes
        return out

    context, size, low, high, times = take("<u8", n_contexts), take("<u4", n_contexts), take("<u4", n), take("<u2", n), take("u1", n)
    large, many = take("<u4", n_large), take("<u4", n_large)
    times = times.astype(np.int64)
    times[large] = many
    return np.repeat(context, size), low | high.astype(np.uint64) << np.uint64(32), times


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    part, block, kind, n, packed = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(block, pa.string()), pa.array(kind, pa.int8()),
                                       pa.array(n, pa.int32()), pa.array(packed, pa.binary())], ["part", "block", "kind", "n", "packed"])


_BLOCK_COLUMNS = ["block", "train", "lengths", "digests", "counts", "tokens"]


def _asked(stored: DataFrame, hot: dict[int, int], parts: int) -> DataFrame:
    shared = stored.sparkSession.sparkContext.broadcast(np.array(list(hot), dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, *fields in common.rows_of(batch):
                out = [(p, name, kind, n, packed) for p, kind, n, packed in _Block(*fields, parts, shared.value).messages()]
                for lo in range(0, len(out), 64):
                    yield _rows(out[lo : lo + 64])

    return stored.select(*_BLOCK_COLUMNS).mapInArrow(run, DEALT).repartitionById(parts, F.col("part"))


# --- step 3: a part's shard of the trie -------------------------------------


def _answer_words(asked: list[tuple]) -> Iterator[tuple]:
    digests = [np.frombuffer(p, dtype="<u8", count=n) for _, n, p in asked]
    counts = [np.frombuffer(p, dtype="<u4", offset=8 * n) for _, n, p in asked]
    distinct, at = np.unique(np.concatenate(digests), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype("<i8")
    yield None, TOTALS, 2, np.array([total.sum(), (total > 0).sum()], dtype="<i8").tobytes()
    lo = 0
    for block, n, _ in asked:
        yield block, WORDS, n, total[at[lo : lo + n]].tobytes()
        lo += n


def _answer_pairs(asked: list[tuple], hot: dict[int, int], mu: float) -> Iterator[tuple]:
    context, word, times = (np.concatenate(c) for c in zip(*[_unpacked_pairs(n, p) for _, n, p in asked], strict=True))
    order = np.lexsort((word, context))
    context, word, times = context[order], word[order], times[order]
    new = np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])])
    begin = np.flatnonzero(new)
    of = np.empty(len(order), dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    context, word, times = context[begin], word[begin], np.add.reduceat(times, begin)
    # the shard of the trie holds what was learned
    learned = times > 0
    u, n = context[learned], times[learned]
    codes, backoffs = np.zeros(0, dtype=np.uint16), np.zeros(0, dtype=np.uint16)
    if len(u):
        first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        all_of = np.add.reduceat(n, first)  # all pairs of a context are here, but for hot ones
        all_of = np.array([hot.get(d, t) for d, t in zip(u[first].astype(np.int64).tolist(), all_of.tolist(), strict=True)], dtype=np.float64)
        backoffs = quantised(mu / (all_of + mu))
        codes = quantised(n / (np.repeat(all_of, np.diff(first, append=len(u))) + mu))
    with tempfile.TemporaryDirectory() as folder:
        BigramTrie.build(u, word[learned], codes, backoffs).save(folder)
        trie = BigramTrie.open(folder)
        c_new = np.concatenate([[True], context[1:] != context[:-1]])
        c, back = trie.context_codes(context[c_new])
        at = np.cumsum(c_new) - 1
        found = trie.pair_codes(c[at], word)
        back = back[at].astype(np.uint16)
        del trie
    back[back == 0] = quantised(np.ones(1))[0]  # a context never learned leaves everything to p(w)
    lo = 0
    for block, n_asked, _ in asked:
        some = of[lo : lo + n_asked]
        yield block, PAIRS, n_asked, np.stack([found[some], back[some]]).astype("<u2").tobytes()
        lo += n_asked


def _answered(asked: DataFrame, hot: dict[int, int], mu: float) -> DataFrame:
    shared = asked.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words, pairs = 0, [], []
        for batch in batches:
            for part, block, kind, n, packed in common.rows_of(batch):
                (words if kind == WORDS else pairs).append((block, n, packed))
        for asked_for, answer in ((words, _answer_words(words)), (pairs, _answer_pairs(pairs, shared.value, mu))):
            if asked_for:
                for reply in answer:
                    yield _rows([(part, *reply)])

    return asked.mapInArrow(run, DEALT)


# --- step 4 -----------------------------------------------------------------


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", mu: float = 20.0,
          part_tokens: int = 750_000) -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score, score (log10).
    ``train`` (a boolean of the columns of ``docs``) says which rows are learned from."""
    spark = docs.sparkSession
    rows = docs.select(common.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"),
                       common.col(text_col).alias("text"))
    stored = common.stored(blocks(rows))
    size, n_train = stored.agg(F.sum("n_tokens"), F.sum("n_train")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // part_tokens))
    hot = _hot(stored, size or 0, n_train or 0, parts)
    replies = common.stored(_answered(_asked(stored, hot, parts), hot, mu))
    common.release_shuffles(spark)
    n_all, n_distinct = 0, 0
    for r in replies.where(F.col("kind") == TOTALS).select("packed").collect():  # one row a part
        a, b = np.frombuffer(r["packed"], dtype="<i8").tolist()
        n_all, n_distinct = n_all + a, n_distinct + b
    hot_keys = spark.sparkContext.broadcast(np.array(list(hot), dtype=np.int64))
    whole = n_all + 0.5 * (n_distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[int, bytes] = {}
        pairs: dict[int, bytes] = {}
        for batch in batches:
            for kind, part, packed, ids, *fields in common.rows_of(batch):
                if kind != BLOCK:
                    (words if kind == WORDS else pairs)[part] = packed
                    continue
                b = _Block(*fields, parts, hot_keys.value)
                count, found, back = b.replies(words, pairs)
                words, pairs = {}, {}
                own = (count + 0.5) / whole
                base = np.log10(own)
                pair = np.log10(found + back * own[b.w])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(b.lengths), pa.array(np.add.reduceat((count > 0)[b.tokens].astype(np.int64), b.first)),
                     pa.array(np.full(len(ids), n_all)), pa.array(np.add.reduceat(base[b.tokens], b.first)),
                     pa.array(np.add.reduceat(pair[b.pair_of], b.first))],
                    ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    left = replies.where(F.col("kind") != TOTALS).select("block", "kind", "part", "packed", F.lit(None).cast("array<long>").alias("ids"),
                                                         *[F.lit(None).cast("binary").alias(c) for c in _BLOCK_COLUMNS[1:]])
    right = stored.select("block", F.lit(BLOCK).cast("byte").alias("kind"), F.lit(0).alias("part"), F.lit(None).cast("binary").alias("packed"),
                          "ids", *_BLOCK_COLUMNS[1:])
    meet = left.union(right).repartition("block").sortWithinPartitions("block", "kind").drop("block")
    return meet.mapInArrow(run, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    out = score(docs, common.fold(F.col("doc_id"), 5) != 1)
    return out.select(F.col("id").alias("doc_id"), (common.fold(F.col("id"), 5) == 1).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")
