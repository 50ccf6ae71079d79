"""Removal of repeated byte strings with a Burrows-Wheeler transform.

A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller id. Exact over the whole corpus, in these steps:

1. Every ``length``-byte window is assigned to its anchor, the leftmost
   smallest digest among its 16-byte grams. Equal windows have equal anchors,
   so only occurrences of one gram need comparing. The windows of an anchor
   occurrence are consecutive; the bytes they span are its context. Anchors
   (not windows) are dealt by gram: digests of gram and context, document,
   position. Equal contexts within a task are first reduced to the smallest
   id, so a group of copies sends one per task.
2. Per gram: of equal contexts all but those of the smallest id are covered
   whole; grams in one document only, or with one context only, are done.
   What is left are the different contexts of one gram.
3. Their bytes are fetched and dealt by gram; the contexts of a gram with more
   than ``BWT_BYTES`` of them are taken apart into single windows, which are
   dealt by their own digest, so no gram is bound to one task: of equal
   windows all but those of the smallest id are covered, first within the
   task that fetched them, then among what such tasks send. For the other
   grams each task leaves out the windows that have a digest of their own and
   builds the Burrows-Wheeler transform of the rest of its contexts, at most
   twice ``BWT_BYTES`` at a time, and expands intervals of rows breadth first:
   intervals of rows sharing k bytes, extended backward by the bytes of the
   transform, are the intervals sharing k + 1, which derives the common prefix
   values in increasing order; it stops at ``length``. Rows then still together
   start with the same ``length`` bytes, and all but those of the smallest id
   are covered.
4. The covered ranges meet their documents and are cut out.

Digests of gram and context together have 96 bits, those of single windows
128; the transform compares bytes, and the digests before it only leave out
windows without an equal one. A very long text is read whole, in blocks that
overlap by a window.

Defined cases: NULL text is the empty text; ids are integers; rows with equal
ids do not count as smaller or larger than each other; a NULL id is neither
compared nor cut; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .shingles import mix

GRAM = 16
BLOCK_BITS = 21  # bytes scanned together; positions in a block take so many bits
LOW48 = np.uint64((1 << 48) - 1)
FLUSH = 1_200_000  # anchors packed together
BWT_BYTES = 3_000_000  # context bytes transformed together; a gram with more is hot
WINDOW_FLUSH = 1_500_000  # windows of hot grams reduced together
SPAN = np.dtype([("r", "<i8"), ("start", "<u4"), ("end", "<u4")])
ANCHOR = [("gram", "<u4", 1), ("gram_hi", "<u2", 1), ("context", "<u4", 1), ("context_hi", "<u2", 1), ("doc", "<u4", 1),
          ("lo", "<u4", 1), ("count", "u1", 1)]
DEALT = "part int, kind byte, n int, packed binary"


def anchors(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For texts laid end to end (text i is data[starts[i]:starts[i+1]]):
    gram and context digests, text number, first window and window count of
    every anchor occurrence. At most 2^BLOCK_BITS bytes."""
    n = len(data)
    empty = np.empty(0, dtype=np.int64)
    if n < length:
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    word = np.ndarray((n - 7,), dtype="<u8", buffer=padded.data, strides=(1,))
    x = word[: n - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += word[8 : 8 + len(x)]
    x *= np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    place = np.uint64((1 << BLOCK_BITS) - 1)
    least = (x & ~place) | np.arange(len(x), dtype=np.uint64)
    reach, grams = 1, length - GRAM + 1  # smallest over ``grams`` neighbours, by doubling
    while reach < grams:
        step = min(reach, grams - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    at = (least & place).astype(np.int64)  # anchor of the window at each position
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(at)]
    ends = starts[1:][text]
    whole = np.arange(len(at)) + length <= ends
    new = np.empty(len(at), dtype=bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    lo = np.flatnonzero(new & whole)
    # a run ends where the next begins or the windows stop being whole
    run_end = np.flatnonzero(np.concatenate([(new[1:] | ~whole[1:]), [True]]) & whole)
    count = run_end - lo + 1
    anchor, end = at[lo], run_end + length
    context = mix(count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (anchor - lo).astype(np.uint64))
    for j in range(-(-(2 * length - GRAM) // GRAM)):
        part = x[np.minimum(lo + j * GRAM, end - GRAM)]
        context = mix(context * np.uint64(0xBF58476D1CE4E5B9) + part)
    return mix(x[anchor]) & LOW48, context & LOW48, text[lo], lo - starts[text[lo]], count


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans sorted by document and start, overlapping or touching ones joined."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["end"], spans["start"], spans["r"]))]
    doc = np.cumsum(np.diff(spans["r"], prepend=spans["r"][0]) != 0).astype(np.int64) << 33
    reach = np.maximum.accumulate(doc + spans["end"])
    first = np.concatenate([[True], (doc + spans["start"])[1:] > reach[:-1]])
    at = np.flatnonzero(first)
    out = spans[at]
    out["end"] = (reach[np.concatenate([at[1:], [len(spans)]]) - 1] - doc[at]).astype(np.uint32)
    return out


def rotations(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the rotations of ``data``, sorted by at least their first ``depth`` bytes."""
    n = len(data)
    around = np.concatenate([data, np.resize(data, 8)])
    key = np.ndarray((n,), dtype=">u8", buffer=around.data, strides=(1,)).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    reach = 8
    while reach < depth:  # rows that are still equal are sorted by the bytes after the first ``reach``
        rows = np.flatnonzero(~first | ~np.append(first[1:], True))
        if not len(rows):
            break
        at = order[rows]
        key = rank[at].astype(np.uint64) * np.uint64(n) + rank[(at + reach) % n].astype(np.uint64)
        by = np.argsort(key)
        key, order[rows] = key[by], at[by]
        first[rows[1:]] |= key[1:] != key[:-1]
        rank[order[rows]] = np.maximum.accumulate(np.where(first[rows], rows, 0))
        reach *= 2
    return order


def common_prefix_groups(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted rotations of ``data``, group of each row): rows of one group
    share at least ``length`` bytes. An interval of rows sharing k bytes is
    extended backward by each byte of the transform in it, which gives the
    intervals sharing k + 1; an end not seen before has the common prefix k,
    and only intervals with such an end are extended further."""
    n = len(data)
    order = rotations(data, length)
    transform = data[order - 1]
    by_byte = np.argsort(transform, kind="stable")
    extended = np.empty(n, dtype=np.int64)  # row of each row's rotation with its byte before it
    extended[by_byte] = np.arange(n)
    byte = transform[by_byte]
    same = byte[1:] == byte[:-1]
    following, previous = np.full(n, n), np.full(n, -1)  # rows with the same byte
    following[by_byte[:-1][same]] = by_byte[1:][same]
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    apart = np.zeros(n + 1, dtype=bool)
    apart[[0, n]] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):
        size = hi - lo
        row = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        last = following[row] >= np.repeat(hi, size)
        first = previous[row] < np.repeat(lo, size)
        # intervals of one level do not overlap, so their sorted starts and ends belong together
        lo, hi = np.sort(extended[row[first]]), np.sort(extended[row[last]]) + 1
        new = ~apart[hi]
        lo, hi = lo[new], hi[new]
        if not len(hi):
            break
        apart[hi] = True
    return order, np.cumsum(apart[:n]) - 1


def recurring(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Which windows ``at`` have a digest that another one has too."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    word = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    digest = np.zeros(len(at), dtype=np.uint64)
    for j in [*range(0, length - 7, 8), length - 8]:
        digest = (digest ^ word[at + j]) * np.uint64(0xBF58476D1CE4E5B9)
        digest ^= digest >> np.uint64(29)
    order = np.argsort(digest)
    digest = digest[order]
    same = digest[1:] == digest[:-1]
    out = np.zeros(len(at), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Per byte position of contexts laid end to end: does the window there
    also start in a context with a smaller id? Context i has counts[i] windows.
    Windows with a digest of their own are left out of the transform: runs of
    the others are laid end to end."""
    out = np.zeros(len(data), dtype=bool)
    counts = counts.astype(np.int64)
    of = np.repeat(np.arange(len(starts)), counts)
    at = np.arange(len(of)) + (starts - np.cumsum(counts) + counts)[of]
    again = recurring(data, at, length)
    of, at = of[again], at[again]
    if not len(at):
        return out
    new = np.concatenate([[True], at[1:] != at[:-1] + 1])
    begin = np.flatnonzero(new)
    windows = np.diff(begin, append=len(at))
    size = windows + length - 1
    place = np.repeat(at[begin] - np.cumsum(size) + size, size) + np.arange(size.sum())
    run = np.repeat(np.arange(len(begin)), size)
    is_window = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size) < windows[run]
    order, group = common_prefix_groups(data[place], length)
    rows = is_window[order]
    own, group, order = ids[of[begin]][run[order[rows]]], group[rows], order[rows]
    edges = np.flatnonzero(np.diff(group, prepend=-1))
    smallest = np.minimum.reduceat(own, edges)[np.cumsum(np.diff(group, prepend=group[0]) != 0)]
    out[place[order[own > smallest]]] = True
    return out


def spans_of(hit: np.ndarray, starts: np.ndarray, counts: np.ndarray, rows: np.ndarray, lo: np.ndarray, length: int) -> np.ndarray:
    at = np.flatnonzero(hit)
    context = np.repeat(np.arange(len(starts)), counts + length - 1)[at]
    out = np.empty(len(at), dtype=SPAN)
    out["r"], out["start"] = rows[context], lo[context] + at - starts[context]
    out["end"] = out["start"] + length
    return merged(out)


# --- packed rows: (part, kind, n, packed) with arrays laid end to end -------

SPANS, WANTS, ANCHORS, CONTEXTS, TEXTS, WINDOWS = range(6)
WANT = np.dtype([("r", "<i8"), ("id", "<i8"), ("gram", "<u8"), ("lo", "<u4"), ("count", "u1"), ("hot", "u1")])
WINDOW = np.dtype([("digest", "<u8"), ("more", "<u8"), ("r", "<i8"), ("id", "<i8"), ("lo", "<u4")])
CONTEXT = np.dtype([("gram", "<u8"), ("r", "<i8"), ("id", "<i8"), ("lo", "<u4"), ("count", "u1")])


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    part, kind, n, packed = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int8()), pa.array(n, pa.int32()),
                                       pa.array(packed, pa.binary())], ["part", "kind", "n", "packed"])


def _deal(values: np.ndarray, part: np.ndarray, kind: int) -> list[tuple[int, int, int, bytes]]:
    if not len(values):
        return []
    order = np.argsort(part, kind="stable")
    values, part = values[order], part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    return [(int(p), kind, len(v), v.tobytes()) for p, v in zip(part[edges], np.split(values, edges[1:]), strict=True)]


def _deal_spans(spans: np.ndarray, parts: int) -> list[tuple[int, int, int, bytes]]:
    return _deal(spans, np.mod(spans["r"], parts), SPANS)


class _Anchors:
    """Anchor occurrences of one task, until they are packed."""

    def __init__(self, parts: int, length: int):
        self.parts, self.length, self.held = parts, length, 0
        self.found: list[tuple[np.ndarray, ...]] = []

    def add(self, texts: list[tuple[int, int, int, bytes]]) -> None:
        """texts: (id, row, offset, bytes) of at most a block together."""
        starts = np.concatenate([[0], np.cumsum([len(t[3]) for t in texts])])
        data = np.frombuffer(b"".join(t[3] for t in texts), dtype=np.uint8)
        gram, context, text, lo, count = anchors(data, starts, self.length)
        ids, r, offset = (np.array([t[k] for t in texts], dtype=np.int64) for k in range(3))
        self.found.append((gram, context, ids[text], r[text], (lo + offset[text]).astype(np.uint32), count.astype(np.uint8)))
        self.held += len(gram)

    def flush(self) -> list[tuple[int, int, int, bytes]]:
        gram, context, ids, r, lo, count = (np.concatenate(c) for c in zip(*self.found, strict=True))
        self.found, self.held = [], 0
        if not len(gram):
            return []
        order = np.lexsort((ids, context, gram))
        gram, context, ids, r, lo, count = (a[order] for a in (gram, context, ids, r, lo, count))
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])])
        larger = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        spans = np.empty(int(larger.sum()), dtype=SPAN)
        spans["r"], spans["start"] = r[larger], lo[larger]
        spans["end"] = lo[larger] + count[larger] + (self.length - 1)
        out = _deal_spans(merged(spans), self.parts)
        gram, context, ids, r, lo, count = (a[~larger] for a in (gram, context, ids, r, lo, count))
        part = (gram % np.uint64(self.parts)).astype(np.int64)
        order = np.lexsort((lo, r, part))
        part = part[order]
        edges = np.flatnonzero(np.diff(part, prepend=-1))
        for p, some in zip(part[edges], np.split(order, edges[1:]), strict=True):
            _, first, doc = np.unique(r[some], return_index=True, return_inverse=True)
            columns = (gram[some].astype("<u4"), (gram[some] >> np.uint64(32)).astype("<u2"), context[some].astype("<u4"),
                       (context[some] >> np.uint64(32)).astype("<u2"), doc.astype("<u4"), lo[some].astype("<u4"), count[some])
            packed = b"".join([len(first).to_bytes(4, "little"), ids[some][first].astype("<i8").tobytes(),
                               r[some][first].astype("<i8").tobytes(), *[c.tobytes() for c in columns]])
            out.append((int(p), ANCHORS, len(some), packed))
        return out


def _unpacked(n: int, packed: bytes) -> tuple[np.ndarray, ...]:
    """gram, context, id, row, lo, count of packed anchors."""
    docs = int.from_bytes(packed[:4], "little")
    at = 4
    tables = []
    for _ in range(2):
        tables.append(np.frombuffer(packed, dtype="<i8", count=docs, offset=at))
        at += 8 * docs
    columns = []
    for _, kind, _ in ANCHOR:
        columns.append(np.frombuffer(packed, dtype=kind, count=n, offset=at))
        at += n * np.dtype(kind).itemsize
    gram, gram_hi, context, context_hi, doc, lo, count = columns
    return (gram | gram_hi.astype(np.uint64) << np.uint64(32), context | context_hi.astype(np.uint64) << np.uint64(32),
            tables[0][doc], tables[1][doc], lo, count)


def _find_anchors(rows: DataFrame, length: int, parts: int) -> DataFrame:
    most = (1 << BLOCK_BITS) - length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, size = _Anchors(parts, length), [], 0
        for batch in batches:
            for i, r, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                for at in range(0, max(1, len(data)), most):  # windows [at, at + most) of a very long text
                    piece = data[at : at + most + length - 1]
                    if len(piece) < length:
                        continue
                    if size + len(piece) > most + length - 1:
                        held.add(block)
                        block, size = [], 0
                    block.append((i, r, at, piece))
                    size += len(piece)
                    if held.held >= FLUSH and (out := held.flush()):
                        yield _rows(out)
        if block:
            held.add(block)
        if held.found and (out := held.flush()):
            yield _rows(out)

    return rows.mapInArrow(run, DEALT).repartitionById(parts, F.col("part"))


def _compare_anchors(dealt: DataFrame, length: int, parts: int) -> DataFrame:
    """Spans of contexts repeated as a whole; wanted contexts of grams with several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            through = []
            for part, kind, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == SPANS:
                    through.append((part, kind, n, packed))
                else:
                    found.append(_unpacked(n, packed))
            if through:
                yield _rows(through)
        if not found:
            return
        gram, context, ids, r, lo, count = (np.concatenate(c) for c in zip(*found, strict=True))
        del found
        order = np.argsort(gram, kind="stable")
        own = gram[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        size = np.diff(first, append=len(own))
        several = np.minimum.reduceat(ids[order], first) != np.maximum.reduceat(ids[order], first)
        keep = order[np.repeat(several, size)]
        if not len(keep):
            return
        gram, context, ids, r, lo, count = (a[keep] for a in (gram, context, ids, r, lo, count))
        order = np.lexsort((ids, context, gram))
        gram, context, ids, r, lo, count = (a[order] for a in (gram, context, ids, r, lo, count))
        new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
        new = new_gram | np.concatenate([[True], context[1:] != context[:-1]])
        larger = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        spans = np.empty(int(larger.sum()), dtype=SPAN)
        spans["r"], spans["start"] = r[larger], lo[larger]
        spans["end"] = lo[larger] + count[larger] + (length - 1)
        out = _deal_spans(merged(spans), parts)
        contexts = np.add.reduceat(new, np.flatnonzero(new_gram))
        open_ = ~larger & (contexts[np.cumsum(new_gram) - 1] > 1)
        n_bytes = np.add.reduceat(np.where(open_, count.astype(np.int64) + (length - 1), 0), np.flatnonzero(new_gram))
        hot = (n_bytes > BWT_BYTES)[np.cumsum(new_gram) - 1]
        wants = np.empty(int(open_.sum()), dtype=WANT)
        for name, values in (("r", r), ("id", ids), ("gram", gram), ("lo", lo), ("count", count), ("hot", hot)):
            wants[name] = values[open_]
        out += _deal(wants, np.mod(wants["r"], parts), WANTS)
        if out:
            yield _rows(out)

    return dealt.mapInArrow(run, DEALT)


def _with_texts(packed: DataFrame, texts: DataFrame, parts: int) -> DataFrame:
    """Packed rows and the texts (id, r, text) of their part, texts last."""
    left = packed.select("part", "kind", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("r"),
                         F.lit(None).cast("string").alias("text"), "packed")
    right = texts.select(F.pmod(F.col("r"), F.lit(parts)).cast("int").alias("part"), F.lit(TEXTS).cast("byte").alias("kind"), "id",
                         "r", "text", F.lit(None).cast("binary").alias("packed"))
    return (left.union(right).repartitionById(parts, F.col("part")).sortWithinPartitions("kind")
            .select("kind", "id", "r", "text", "packed"))


def windows_of(wants: np.ndarray, pieces: list[bytes], length: int) -> np.ndarray:
    """Every window of the contexts ``pieces``, with two digests of its bytes."""
    data = np.frombuffer(b"".join(pieces) + bytes(8), dtype=np.uint8)
    counts = wants["count"].astype(np.int64)
    context = np.repeat(np.arange(len(wants)), counts)
    within = np.arange(len(context)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (np.cumsum(counts + length - 1) - (counts + length - 1))[context] + within
    word = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data.data, strides=(1,))
    out = np.empty(len(at), dtype=WINDOW)
    digest, more = np.zeros(len(at), dtype=np.uint64), np.full(len(at), 0xD6E8FEB86659FD93, dtype=np.uint64)
    for j in [*range(0, length - 7, 8), length - 8]:
        part = word[at + j]
        digest = mix(digest * np.uint64(0xBF58476D1CE4E5B9) + part)
        more = mix((more ^ part) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j + 1))
    out["digest"], out["more"], out["r"], out["id"] = digest, more, wants["r"][context], wants["id"][context]
    out["lo"] = wants["lo"][context] + within
    return out


def repeated(windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(spans of the windows that equal one of a smaller id, the other windows)."""
    windows = windows[np.lexsort((windows["id"], windows["more"], windows["digest"]))]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (windows["digest"][1:] != windows["digest"][:-1]) | (windows["more"][1:] != windows["more"][:-1])
    larger = windows["id"] > windows["id"][np.flatnonzero(new)][np.cumsum(new) - 1]
    spans = np.empty(int(larger.sum()), dtype=SPAN)
    spans["r"], spans["start"] = windows["r"][larger], windows["lo"][larger]
    spans["end"] = spans["start"] + np.uint32(length)
    return merged(spans), windows[~larger]


def _fetch_contexts(both: DataFrame, length: int, parts: int) -> DataFrame:
    def packed(wants: np.ndarray, pieces: list[bytes]) -> list[tuple[int, int, int, bytes]]:
        part = (wants["gram"] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order], prepend=-1))
        out = []
        for p, some in zip(part[order][edges], np.split(order, edges[1:]), strict=True):
            head = np.empty(len(some), dtype=CONTEXT)
            for name in CONTEXT.names:
                head[name] = wants[name][some]
            out.append((int(p), CONTEXTS, len(some), head.tobytes() + b"".join([pieces[i] for i in some.tolist()])))
        return out

    def sent(wants: np.ndarray, pieces: list[bytes]) -> list[tuple[int, int, int, bytes]]:
        hot = wants["hot"] > 0
        if not hot.any():
            return packed(wants, pieces)
        spans, left = repeated(windows_of(wants[hot], [pieces[i] for i in np.flatnonzero(hot).tolist()], length), length)
        out = _deal_spans(spans, parts) + _deal(left, (left["digest"] % np.uint64(parts)).astype(np.int64), WINDOWS)
        return out + (packed(wants[~hot], [pieces[i] for i in np.flatnonzero(~hot).tolist()]) if not hot.all() else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        early: list[np.ndarray] = []
        wants = None
        held: list[np.ndarray] = []
        pieces: list[bytes] = []
        n_windows = 0
        for batch in batches:
            for kind, r, text, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                                           batch.column(4).to_pylist(), strict=True):
                if kind == WANTS:
                    early.append(np.frombuffer(blob, dtype=WANT))
                    continue
                if wants is None:
                    wants = np.concatenate([*early, np.empty(0, dtype=WANT)])
                    wants = wants[np.argsort(wants["r"], kind="stable")]
                lo, hi = np.searchsorted(wants["r"], r), np.searchsorted(wants["r"], r, side="right")
                if lo == hi:
                    continue
                own = np.unique(wants[lo:hi])
                data = text.encode("utf-8", "surrogatepass")
                pieces += [data[a : a + n + length - 1] for a, n in zip(own["lo"].tolist(), own["count"].tolist(), strict=True)]
                held.append(own)
                n_windows += int(own["count"][own["hot"] > 0].sum())
                if len(pieces) > 100_000 or n_windows > WINDOW_FLUSH:
                    yield _rows(sent(np.concatenate(held), pieces))
                    held, pieces, n_windows = [], [], 0
        if pieces:
            yield _rows(sent(np.concatenate(held), pieces))

    return both.mapInArrow(run, DEALT).repartitionById(parts, F.col("part"))


def _compare_contexts(dealt: DataFrame, length: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, blobs, windows = [], [], []
        for batch in batches:
            through = []
            for part, kind, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == SPANS:
                    through.append((part, kind, n, blob))
                    continue
                if kind == WINDOWS:
                    windows.append(np.frombuffer(blob, dtype=WINDOW))
                    continue
                heads.append(np.frombuffer(blob, dtype=CONTEXT, count=n))
                blobs.append(np.frombuffer(blob, dtype=np.uint8, offset=n * CONTEXT.itemsize))
            if through:
                yield _rows(through)
        if windows:
            out = _deal_spans(repeated(np.concatenate(windows), length)[0], parts)
            del windows
            if out:
                yield _rows(out)
        if not heads:
            return
        head, data = np.concatenate(heads), np.concatenate(blobs)
        del heads, blobs
        size = head["count"].astype(np.int64) + length - 1
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        order = np.argsort(head["gram"], kind="stable")
        gram, so_far = head["gram"][order], np.cumsum(size[order])
        cuts, lo = [], 0
        while lo < len(order):  # whole grams, about BWT_BYTES together
            hi = int(np.searchsorted(so_far, (so_far[lo - 1] if lo else 0) + BWT_BYTES, side="right"))
            hi = max(hi, lo + 1)
            hi = int(np.searchsorted(gram, gram[hi - 1], side="right"))
            cuts.append(order[lo:hi])
            lo = hi
        for some in cuts:
            h, s = head[some], size[some]
            begins = np.concatenate([[0], np.cumsum(s)[:-1]])
            text = data[np.repeat(start[some] - begins, s) + np.arange(int(s.sum()))]
            counts = h["count"].astype(np.int64)
            hit = covered(text, begins, counts, h["id"], length)
            out = _deal_spans(spans_of(hit, begins, counts, h["r"], h["lo"].astype(np.int64), length), parts)
            if out:
                yield _rows(out)

    return dealt.mapInArrow(run, DEALT)


def _cut(both: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        early: list[np.ndarray] = []
        spans = None
        for batch in batches:
            ids, n_bytes, removed, n_spans, kept = [], [], [], [], []
            for kind, i, r, text, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == SPANS:
                    early.append(np.frombuffer(blob, dtype=SPAN))
                    continue
                if spans is None:
                    spans = merged(np.concatenate([*early, np.empty(0, dtype=SPAN)]))
                    early = []
                data = (text or "").encode("utf-8", "surrogatepass")
                own = spans[np.searchsorted(spans["r"], r) : np.searchsorted(spans["r"], r, side="right")]
                ends = own["end"].tolist()
                left = b"".join([data[a:b] for a, b in zip([0, *ends], [*own["start"].tolist(), len(data)], strict=True)])
                ids.append(i)
                n_bytes.append(len(data))
                removed.append(len(data) - len(left))
                n_spans.append(len(ends))
                kept.append(left)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                                                 ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return both.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                    part_bytes: int = 24_000_000) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans and the kept bytes. ``length`` is 16 to 255."""
    spark = docs.sparkSession
    rows = common.pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text")
    rows = rows.withColumn("r", F.xxhash64("id", "text")).select("id", "r", "text")
    known = rows.where("id is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    common.ship(spark)
    found = common.stored(_compare_anchors(_find_anchors(known, length, parts), length, parts))
    common.release_shuffles(spark)
    wants = _with_texts(found.where(F.col("kind") == WANTS), known, parts)
    more = common.stored(_compare_contexts(_fetch_contexts(wants, length, parts), length, parts))
    common.release_shuffles(spark)
    return _cut(_with_texts(found.where(F.col("kind") == SPANS).union(more), rows, parts))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(common.documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 49)) AS pos FROM d WHERE length(h) >= 100),
g AS (SELECT p.doc_id, pos, substr(h, CAST(2 * pos + 1 AS BIGINT), 100) AS s FROM p JOIN d USING (doc_id)),
f AS (SELECT s, min(doc_id) AS first_id FROM g GROUP BY s),
c AS (SELECT doc_id, pos FROM g JOIN f USING (s) WHERE first_id < doc_id),
b AS (SELECT doc_id, pos, pos > coalesce(lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50, -1) AS new FROM c),
k AS (SELECT doc_id, pos, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM b),
r AS (SELECT doc_id, run, min(pos) AS lo, max(pos) + 50 AS hi FROM k GROUP BY doc_id, run),
l AS (SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS from_at FROM r),
t AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last_hi,
             string_agg(substr(h, CAST(2 * from_at + 1 AS BIGINT), CAST(2 * (lo - from_at) AS BIGINT)), '' ORDER BY lo) AS kept
      FROM l JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN t.doc_id IS NULL THEN h ELSE kept || substr(h, CAST(2 * last_hi + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""
