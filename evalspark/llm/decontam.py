"""Benchmark decontamination by edit distance over words.

A document holds an item when some stretch of its words is within
``(100 - percent)`` % of the item's words in edit distance. Candidates come
from locality-sensitive hashing:

* the CGK random walk embeds a word sequence so that edit distance becomes
  Hamming distance: step j writes the current word and moves on when a random
  bit of (step, word) says so;
* item-sized windows of the document are embedded the same way, and keys of a
  few sampled positions, repeated over several walks and samples
  (``target_recall`` sets how many), are looked up among the items' keys;
* every candidate is verified exactly: the smallest edit distance of the item
  to any stretch of words around the window (bit-parallel, whole item).

Only windows that can hold an item are embedded: an item of n words with at
most k edits leaves one of k + 1 equal pieces intact, so a window starts where
a piece's first words occur, shifted by the place of the piece.

Items are the stated query set: they are read in blocks of about
``block_chars`` characters, each checked and broadcast, and every block meets
all documents in one narrow pass without a shuffle.

Defined cases: words are runs of letters, digits and underscores, lower-cased;
NULL and empty texts hold nothing; an item without words is held by nothing;
equal items are each reported; repeated rows are each reported; NULL ids keep
their row; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common
from .shingles import mix

WORD = re.compile(r"\w+")
STRETCH = 1.5  # steps of a walk per word: it moves on at every other step, so nearly all walks still write words at their end
SAMPLED = 2  # positions in a key
WALKS = 8
SURVIVES = 0.35  # share of positions that still agree, for the planned number of samples
PIECE = 3
TEXT_SLICE = 2_000_000
WINDOWS = 4096


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def most_edits(n: int, percent: int) -> int:
    return n * (100 - percent) // 100


def embedded(words: np.ndarray, lengths: np.ndarray, walk: int) -> np.ndarray:
    """CGK walks of the rows of ``words`` (0 past a row's length): the word
    written at each of STRETCH * n steps of a row of n words."""
    steps = math.ceil(STRETCH * words.shape[1])
    at = np.zeros(len(words), dtype=np.int64)
    rows = np.arange(len(words))
    out = np.zeros((len(words), steps), dtype=np.uint64)
    padded = np.concatenate([words, np.zeros((len(words), 1), dtype=np.uint64)], axis=1)
    for j in range(steps):
        here = padded[rows, at]
        out[:, j] = here
        bit = mix(here ^ np.uint64((walk * 1_000_003 + j + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) & np.uint64(1)
        at = np.minimum(at + bit.astype(np.int64), lengths)
    return out


def samples_for(target_recall: float) -> int:
    """Samples per walk so that all together reach the target."""
    one = SURVIVES**SAMPLED
    return max(1, math.ceil(math.log(1 - target_recall) / math.log(1 - one) / WALKS))


def keys(words: np.ndarray, lengths: np.ndarray, samples: int) -> np.ndarray:
    """Per row WALKS * samples keys of sampled positions of its embedding."""
    out = []
    for walk in range(WALKS):
        wrote = embedded(words, lengths, walk)
        for s in range(samples):
            key = mix(lengths.astype(np.uint64) + np.uint64((walk * 1000 + s) * 0xD6E8FEB86659FD93 & (2**64 - 1)))
            for k in range(SAMPLED):
                share = (int(mix(np.array([walk * 7919 + s * 31 + k + 1], dtype=np.uint64))[0]) >> 11) / 2**53
                place = np.minimum((share * STRETCH * lengths).astype(np.int64), wrote.shape[1] - 1)
                key = mix(key ^ (wrote[np.arange(len(words)), place] + np.uint64(k + 1)))
            out.append(key)
    return np.stack(out, axis=1)


def edits(pattern_bits: dict[int, int], n: int, text: list[int]) -> int:
    """Smallest edit distance of a pattern of n words to any stretch of ``text``
    (bit-parallel columns; pattern_bits: word -> its places)."""
    full = (1 << n) - 1
    top = 1 << (n - 1)
    vp, vn, score = full, 0, n
    best = n
    for w in text:
        eq = pattern_bits.get(w, 0)
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = hp << 1 & full, hn << 1 & full
        vp = (hn | ~(d0 | hp)) & full
        vn = d0 & hp
        best = min(best, score)
    return best


@dataclass
class ItemIndex:
    """One block of items: words numbered from 1, pieces, and embedding keys."""

    ids: list
    items: list[np.ndarray]
    numbers: dict[str, int]
    allowed: list[int]
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # piece size -> sorted digests, shift, item length
    key_values: np.ndarray
    key_items: np.ndarray
    samples: int


def _digest(words: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(words[0]), dtype=np.uint64)
    for w in words:
        out = mix(out * np.uint64(0xBF58476D1CE4E5B9) + w.astype(np.uint64))
    return out


def index(rows: list[tuple], percent: int, target_recall: float) -> ItemIndex:
    """rows: (item id, text)."""
    numbers: dict[str, int] = {}
    ids, items = [], []
    for i, text in rows:
        words = words_of(text)
        if words:
            ids.append(i)
            items.append(np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], dtype=np.uint64))
    allowed = [most_edits(len(x), percent) for x in items]
    pieces: dict[int, list[tuple[int, int, int]]] = {}
    for x, k in zip(items, allowed, strict=True):
        n = len(x)
        cuts = [n * j // (k + 1) for j in range(k + 2)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            size = min(PIECE, b - a)
            digest = _digest([x[a + t : a + t + 1] for t in range(size)])
            pieces.setdefault(size, []).append((int(digest[0]), a, n))
    sorted_pieces = {}
    for size, found in pieces.items():
        found = sorted(set(found))
        sorted_pieces[size] = (np.array([f[0] for f in found], dtype=np.uint64), np.array([f[1] for f in found], dtype=np.int64),
                               np.array([f[2] for f in found], dtype=np.int64))
    samples = samples_for(target_recall)
    values, owners = [], []
    by_length: dict[int, list[int]] = {}
    for i, x in enumerate(items):
        by_length.setdefault(len(x), []).append(i)
    for n, some in by_length.items():
        k = keys(np.stack([items[i] for i in some]), np.full(len(some), n), samples)
        values.append(k.ravel())
        owners.append(np.repeat(np.array(some), k.shape[1]))
    value = np.concatenate([*values, np.empty(0, dtype=np.uint64)])
    owner = np.concatenate([*owners, np.empty(0, dtype=np.int64)])
    order = np.argsort(value, kind="stable")
    return ItemIndex(ids, items, numbers, allowed, sorted_pieces, value[order], owner[order], samples)


def _ranges(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which wanted, place among the sorted values) of every equal pair."""
    lo = np.searchsorted(sorted_values, wanted)
    n = np.searchsorted(sorted_values, wanted, side="right") - lo
    which = np.repeat(np.arange(len(wanted)), n)
    return which, np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(len(which))


def windows(flat: np.ndarray, doc: np.ndarray, begin: np.ndarray, ix: ItemIndex) -> np.ndarray:
    """Distinct (first word, item length) that can hold an item; places are those of ``flat``."""
    found = [np.empty((0, 2), dtype=np.int64)]
    for size, (digest, shift, length) in ix.pieces.items():
        known = flat > 0
        at = known[: max(0, len(flat) - size + 1)].copy()
        for t in range(1, size):
            at &= known[t : t + len(at)]
            at &= doc[t : t + len(at)] == doc[: len(at)]
        at = np.flatnonzero(at)
        which, place = _ranges(digest, _digest([flat[at + t] for t in range(size)])) if len(at) else (at, at)
        start = np.maximum(at[which] - shift[place], begin[doc[at[which]]])
        found.append(np.stack([start, length[place]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def held_items(texts: list[str | None], ix: ItemIndex, bits: dict[int, dict[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(text number, item number, edits) of every held item."""
    lists = [words_of(t) for t in texts]
    get = ix.numbers.get
    flat = np.fromiter(map(get, chain.from_iterable(lists), repeat(0)), dtype=np.int64).astype(np.uint64)
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(lists)), sizes)
    all_windows = windows(flat, doc, begin, ix)
    best: dict[tuple[int, int], int] = {}
    for lo in range(0, len(all_windows), WINDOWS):
        start, n = all_windows[lo : lo + WINDOWS].T
        text = doc[start]
        end = (begin + sizes)[text]
        place = start[:, None] + np.arange(int(n.max()))
        inside = (np.arange(place.shape[1]) < n[:, None]) & (place < end[:, None])
        words = np.where(inside, flat[np.minimum(place, len(flat) - 1)], np.uint64(0))
        k = keys(words, n, ix.samples)
        which, at = _ranges(ix.key_values, k.ravel())
        pairs = np.unique(np.stack([which // k.shape[1], ix.key_items[at]], axis=1), axis=0)
        for w, item in pairs.tolist():
            allowed, size = ix.allowed[item], len(ix.items[item])
            key = (int(text[w]), item)
            if best.get(key) == 0:
                continue
            if item not in bits:
                own: dict[int, int] = {}
                for p, x in enumerate(ix.items[item].tolist()):
                    own[x] = own.get(x, 0) | 1 << p
                bits[item] = own
            a, b = max(int(begin[text[w]]), int(start[w]) - 2 * allowed), min(int(end[w]), int(start[w]) + size + 2 * allowed)
            near = flat[a:b].tolist()
            if sum(map(bits[item].__contains__, near)) < size - allowed:
                continue  # within the allowed edits so many words stay
            d = edits(bits[item], size, near)
            if d <= allowed and d < best.get(key, size + 1):
                best[key] = d
    for (t, item), d in sorted(best.items()):
        yield t, item, d


def _blocks(items: DataFrame, item_id_col: str, item_text_col: str, percent: int, target_recall: float,
            block_chars: int) -> Iterator[Broadcast]:
    """The items' indexes, each of a block of bounded size, so it may be collected and broadcast."""
    wanted = common.pick(items, item_id=item_id_col, text=item_text_col).where("text is not null")
    chars = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    common.ship(items.sparkSession)
    for block in range(blocks):
        some = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        own = sorted(((r["item_id"], r["text"]) for r in some.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield items.sparkSession.sparkContext.broadcast(index(own, percent, target_recall))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                 item_text_col: str = "text", percent: int = 75, target_recall: float = 0.999,
                 block_chars: int = 20_000_000) -> DataFrame:
    """id, item_id, n_words (of the item), edits: one row per item that a row of ``docs`` holds."""
    rows = common.pick(docs, id=id_col, text=text_col)
    names = ["id", "item_id", "n_words", "edits"]
    schema = rows.select("id").schema
    schema.add("item_id", items.schema[item_id_col].dataType).add("n_words", "long").add("edits", "long")
    item_type = to_arrow_type(items.schema[item_id_col].dataType)
    out = None
    for shared in _blocks(items, item_id_col, item_text_col, percent, target_recall, block_chars):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ix, bits = shared.value, {}
            if not ix.items:
                return
            for batch in batches:
                texts = batch.column(1).to_pylist()
                at, item, n, d = [], [], [], []
                for lo, hi in common.slices([t or "" for t in texts], TEXT_SLICE):
                    for t, i, e in held_items(texts[lo:hi], ix, bits):
                        at.append(lo + t)
                        item.append(ix.ids[i])
                        n.append(len(ix.items[i]))
                        d.append(e)
                if at:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(item, item_type),
                                                      pa.array(n, pa.int64()), pa.array(d, pa.int64())], names)

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _clean(shared: Broadcast, text: Column) -> Column:
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ix, bits = shared.value, {}
        for batch in batches:
            texts = batch.tolist()
            out = np.ones(len(texts), dtype=bool)
            if ix.items:
                for lo, hi in common.slices([t or "" for t in texts], TEXT_SLICE):
                    for t, _, _ in held_items(texts[lo:hi], ix, bits):
                        out[lo + t] = False
            yield pd.Series(out)

    return clean(text)


def without_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                  percent: int = 75, target_recall: float = 0.999, block_chars: int = 20_000_000) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no item; a filter, no shuffle."""
    for shared in _blocks(items, item_id_col, item_text_col, percent, target_recall, block_chars):
        docs = docs.where(_clean(shared, common.col(text_col)))
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = contaminated(common.documents(spark, sf_dir), items)
    return out.select(F.col("id").alias("doc_id"), "item_id", "n_words", "edits", (1 - F.col("edits") / F.col("n_words")).alias("similarity"))
