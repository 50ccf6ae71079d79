"""MinHash near-duplicates by fast similarity sketching.

A document is its set of distinct word shingles; two link when their Jaccard
similarity is at least ``percent`` / 100.

1. Sketching: in each round every shingle falls into one hashed bin and leaves
   its hashed value there if the bin's value is from no earlier round and not
   smaller. Most sets fill all ``size`` bins within a few rounds; the last
   ``size`` rounds are aimed at one bin each, so every coordinate fills even
   for a set of one shingle, and the share of equal coordinates of two sets is
   concentrated about their similarity. One byte of each coordinate is kept.
2. Equal sets collapse to one class (its smallest id stands for it).
3. Banding: 50 bands of 6 coordinates; a pair at 0.80 shares no band with a
   probability of 0.738^50, about 3 in 10^7. Every document of a band's bucket
   is first compared with the bucket's smallest id only (one exact comparison
   a document); the links already join most of every large group.
4. Buckets with more than one component are looked at again: the members
   outside the bucket's main component meet all others, both dealt in tiles of
   bounded size. Pairs of different components whose sketches agree to no less
   than the threshold less five standard deviations are candidates.
5. Candidates are packed by pair of document tiles. A document's full set goes
   once to each pair of tiles that has a candidate of it; there the candidates
   are compared exactly, the most alike first, unless links found so far have
   joined the two already. No pair travels as a row of its own.

Defined cases: NULL text or a text without words is the empty set and links
with nothing; rows with the same id are one node; a NULL id keeps its row, in
the component of its copies if it has any, and is kept if it has none; equal
similarities need no order, components do not depend on it; very long texts
are sketched and compared whole; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, graph
from .shingles import Words, mix, shingle_sets

BANDS, ROWS = 50, 6
SIZE = BANDS * ROWS
CELLS = 2048  # values of several rounds made at once
TILE = 2000  # members of a bucket in a group
DOC_TILE = 1000  # documents whose sets meet in a group, by two
DEALT_PAIRS = 500_000  # candidates packed together
PAIR = np.dtype([("a", "<i8"), ("b", "<i8"), ("root_a", "<i8"), ("root_b", "<i8"), ("equal", "<i4")])
PAIR_BLOCK = 100_000
LOW32 = np.uint64(0xFFFFFFFF)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
SALT = mix(np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BAND_SALT = mix(SALT[:BANDS] + np.uint64(1))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """SIZE bytes for a set of one token at least."""
    best = np.full(SIZE, EMPTY)
    at = 0
    while at < SIZE and (not at or (best == EMPTY).any()):
        rounds = np.arange(at, min(SIZE, at + max(1, CELLS // len(tokens))), dtype=np.uint64)
        h = mix(tokens[None, :] ^ SALT[rounds.astype(np.int64)][:, None])
        bins = ((h >> np.uint64(32)) * np.uint64(SIZE)) >> np.uint64(32)
        np.minimum.at(best, bins.ravel().astype(np.int64), ((rounds[:, None] << np.uint64(32)) | (h & LOW32)).ravel())
        at += len(rounds)
    left = np.flatnonzero(best == EMPTY)
    if len(left):
        last = SIZE + left
        h = mix(tokens[None, :] ^ SALT[last][:, None]) & LOW32
        best[left] = (last.astype(np.uint64) << np.uint64(32)) | h.min(axis=1)
    return (mix(best) >> np.uint64(56)).astype(np.uint8)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """(documents, SIZE) bytes -> (documents, BANDS) keys."""
    wide = sketches.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.zeros(wide.shape[:2], dtype=np.uint64)
    for i in range(ROWS):
        key |= wide[:, :, i] << np.uint64(8 * i)
    return mix(key ^ BAND_SALT[None, :]).view(np.int64)


def least_equal(percent: int) -> int:
    """Equal coordinates that a linked pair has but for one case in millions."""
    p = percent / 100
    return math.floor(SIZE * (p - 5 * math.sqrt(p * (1 - p) / SIZE)))


def _signatures(rows: DataFrame, words_each: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            n, key, made = [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), words_each, words):
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) if len(s) else None)
                made.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(made, pa.binary())],
                                             ["id", "n", "key", "sketch"])

    common.ship(rows.sparkSession)
    return rows.mapInArrow(run, "id long, n long, key binary, sketch binary")


def _bands(classes: DataFrame) -> DataFrame:
    """band, a: one row per class and band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8))
                ids = pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), ids], ["band", "a"])

    return classes.select("rep", "sketch").mapInArrow(run, "band long, a long")


def _sets(words_each: int):
    """id, text -> id, its whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            s = [x.astype("<u8").tobytes() for x in shingle_sets(batch.column(1).to_pylist(), words_each, words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.binary())], ["id", "s"])

    return run


def _linked(rows: DataFrame, pairs: DataFrame, words_each: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_alike(np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8"), percent) for _, _, x, y in common.rows_of(batch)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    found = common.stored(rows.join(common.shuffled(wanted), "id", "left_semi").mapInArrow(_sets(words_each), "id long, s binary"))
    both = (pairs.join(common.shuffled(found.select(F.col("id").alias("a"), F.col("s").alias("s_a"))), "a")
            .join(common.shuffled(found.select(F.col("id").alias("b"), F.col("s").alias("s_b"))), "b").select("a", "b", "s_a", "s_b"))
    return common.stored(both.mapInArrow(confirm, "a long, b long").distinct())


def _mixed(bands: DataFrame, roots: DataFrame) -> DataFrame:
    """band, a, root, minor, tiles, sides of the members of the buckets with
    several components; minor ones are outside the bucket's main component."""
    placed = (bands.join(common.shuffled(roots), bands["a"] == F.col("node"), "left")
              .select("band", "a", F.coalesce("root", "a").alias("root")))
    mixed = (placed.groupBy("band", "root").agg(F.count("*").alias("k"))
             .groupBy("band").agg(F.sum("k").alias("members"), F.max("k").alias("most"), F.count("*").alias("roots"),
                                  F.max_by("root", F.struct("k", "root")).alias("main"))
             .where("roots > 1").select("band", "main", F.ceil(F.col("members") / TILE).cast("int").alias("tiles"),
                                        F.ceil((F.col("members") - F.col("most")) / TILE).cast("int").alias("sides")))
    return placed.join(common.shuffled(mixed), "band").withColumn("minor", F.col("root") != F.col("main")).drop("main")


def _met(live: DataFrame, classes: DataFrame) -> DataFrame:
    """The members (role 1) and the minor ones (role 0), both dealt in tiles of
    about TILE rows, each pair of tiles in a group of its own."""
    live = live.join(common.shuffled(classes.select(F.col("rep").alias("a"), "n", "sketch")), "a")
    columns = ["band", "tile", "side", "a", "root", "n", "sketch", "minor", "role"]
    members = (live.withColumn("tile", F.pmod(F.xxhash64("a"), F.col("tiles")).cast("int"))
               .withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).withColumn("role", F.lit(1)))
    outside = (live.where("minor").withColumn("side", F.pmod(F.xxhash64("a"), F.col("sides")).cast("int"))
               .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("role", F.lit(0)))
    return members.select(*columns).union(outside.select(*columns))


def _candidates(met: DataFrame, percent: int, doc_tiles: int) -> DataFrame:
    """Pairs of different components whose sketches agree enough, each from the
    first band that the two share, packed by the tiles (x, y) of their documents;
    and rows (x, y, id, root) of the documents themselves."""
    least = least_equal(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        found: list[np.ndarray] = []

        def groups() -> Iterator[pa.Table]:
            nonlocal held
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) < TILE:
                    continue
                table = pa.Table.from_batches(held)
                last = np.flatnonzero(_group_edges(table))[-1]  # the last group may go on
                yield table.slice(0, last)
                held = table.slice(last).to_batches()
            if held:
                yield pa.Table.from_batches(held)

        for table in groups():
            for some in _pairs(table, percent, least):
                found.append(some)
                if sum(map(len, found)) >= DEALT_PAIRS:
                    yield _dealt(np.concatenate(found), doc_tiles)
                    found = []
        if found:
            yield _dealt(np.concatenate(found), doc_tiles)

    return (met.repartition("band", "tile", "side").sortWithinPartitions("band", "tile", "side", "role")
            .mapInArrow(run, "x int, y int, id long, root long, packed binary"))


def _group_edges(table: pa.Table) -> np.ndarray:
    band, tile, side = (table[c].to_numpy() for c in ("band", "tile", "side"))
    return np.concatenate([[True], (band[1:] != band[:-1]) | (tile[1:] != tile[:-1]) | (side[1:] != side[:-1])])


def _pairs(table: pa.Table, percent: int, least: int) -> Iterator[np.ndarray]:
    if not table.num_rows:
        return
    band, a, root, n = (table[c].to_numpy() for c in ("band", "a", "root", "n"))
    minor, role = table["minor"].to_numpy(zero_copy_only=False).astype(bool), table["role"].to_numpy()
    sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint8).reshape(-1, SIZE)
    keys = band_keys(sketches)
    group = np.cumsum(_group_edges(table)) - 1
    size = np.bincount(group)
    outside = np.bincount(group, weights=role == 0).astype(np.int64)  # role 0 comes first
    start = np.cumsum(size) - size
    xs = np.flatnonzero(role == 0)
    each = (size - outside)[group[xs]]
    total = np.concatenate([[0], np.cumsum(each)])
    lo = 0
    while lo < len(xs):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIR_BLOCK, side="right")) - 1)
        x = np.repeat(xs[lo:hi], each[lo:hi])
        y = np.arange(len(x)) - np.repeat(total[lo:hi] - total[lo], each[lo:hi]) + (start + outside)[group[x]]
        lo = hi
        ok = (root[x] != root[y]) & (~minor[y] | (a[x] < a[y])) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
        x, y = x[ok], y[ok]
        first = keys[x, np.argmax(keys[x] == keys[y], axis=1)] == band[x]
        x, y = x[first], y[first]
        equal = (sketches[x] == sketches[y]).sum(axis=1)
        ok = equal >= least
        x, y = x[ok], y[ok]
        pairs = np.zeros(len(x), dtype=PAIR)
        pairs["a"], pairs["b"], pairs["equal"], pairs["root_a"], pairs["root_b"] = a[x], a[y], equal[ok], root[x], root[y]
        if len(pairs):
            yield pairs


def _dealt(pairs: np.ndarray, doc_tiles: int) -> pa.RecordBatch:
    x, y = ((mix(pairs[c].astype(np.uint64)) % np.uint64(doc_tiles)).astype(np.int64) for c in ("a", "b"))
    at = np.minimum(x, y) * doc_tiles + np.maximum(x, y)
    order = np.argsort(at, kind="stable")
    pairs, at = pairs[order], at[order]
    edges = np.flatnonzero(np.diff(at, prepend=-1))
    docs, roots, which = (np.concatenate(c) for c in ((pairs["a"], pairs["b"]), (pairs["root_a"], pairs["root_b"]), (at, at)))
    order = np.lexsort((docs, which))
    docs, roots, which = docs[order], roots[order], which[order]
    first = np.concatenate([[True], (docs[1:] != docs[:-1]) | (which[1:] != which[:-1])])
    docs, roots, which = docs[first], roots[first], which[first]
    place = np.concatenate([which, at[edges]])
    k, m = len(docs), len(edges)
    return pa.RecordBatch.from_arrays(
        [pa.array((place // doc_tiles).astype(np.int32)), pa.array((place % doc_tiles).astype(np.int32)),
         pa.concat_arrays([pa.array(docs), pa.nulls(m, pa.int64())]), pa.concat_arrays([pa.array(roots), pa.nulls(m, pa.int64())]),
         pa.concat_arrays([pa.nulls(k, pa.binary()), pa.array([p.tobytes() for p in np.split(pairs, edges[1:])], pa.binary())])],
        ["x", "y", "id", "root", "packed"])


def _compared(rows: DataFrame, candidates: DataFrame, words_each: int, percent: int) -> DataFrame:
    """Links (a, b) among the packed candidates that join components."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sets, roots, pairs = None, {}, {}, []
        for batch in batches:
            for x, y, i, root, packed, s in common.rows_of(batch):
                if (x, y) != place:
                    yield _links(sets, roots, pairs, percent)
                    place, sets, roots, pairs = (x, y), {}, {}, []
                if packed is None:
                    roots[i] = root
                    if not any(t.tobytes() == s for t in sets.setdefault(i, [])):  # an id may have several texts
                        sets[i].append(np.frombuffer(s, dtype="<u8"))
                else:
                    pairs.append(np.frombuffer(packed, dtype=PAIR))
        yield _links(sets, roots, pairs, percent)

    docs = candidates.where("packed is null").select("x", "y", "id", "root").distinct()
    wanted = docs.select("id").distinct()
    found = rows.join(common.shuffled(wanted), "id", "left_semi").mapInArrow(_sets(words_each), "id long, s binary")
    docs = docs.join(common.shuffled(found), "id").select("x", "y", "id", "root", F.lit(None).cast("binary").alias("packed"), "s")
    pairs = candidates.where("packed is not null").select("x", "y", "id", "root", "packed", F.lit(None).cast("binary").alias("s"))
    return common.stored(docs.union(pairs).repartition("x", "y").sortWithinPartitions("x", "y", F.col("packed").isNotNull())
                         .mapInArrow(confirm, "a long, b long"))


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _links(sets: dict[int, list[np.ndarray]], roots: dict[int, int], pairs: list[np.ndarray], percent: int) -> pa.RecordBatch:
    joined: dict[int, int] = {}

    def find(i: int) -> int:
        while i in joined:
            i = joined[i]
        return i

    links = []
    if pairs:
        ordered = np.concatenate(pairs)
        for a, b in ordered[np.argsort(-ordered["equal"], kind="stable")][["a", "b"]].tolist():
            p, q = find(roots[a]), find(roots[b])
            if p != q and any(_alike(s, t, percent) for s in sets[a] for t in sets[b]):
                joined[p] = q
                links.append((a, b))
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 4, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept. Ids are integers."""
    spark = docs.sparkSession
    rows = common.pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    signed = common.stored(_signatures(rows, words_each))
    classes = common.stored(signed.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    heads = classes.where("rep is not null")
    bands = common.stored(_bands(heads).distinct())
    common.release_shuffles(spark)

    hubs = bands.groupBy("band").agg(F.min("a").alias("hub"), F.max("a").alias("other")).where("hub <> other").select("band", "hub")
    stars = (bands.join(common.shuffled(hubs), "band").where("a <> hub").groupBy("a", "hub").agg(F.count("*").alias("k"))
             .groupBy("a").agg(F.max_by("hub", F.struct("k", -F.col("hub"))).alias("b")))
    links = _linked(rows, common.stored(stars), words_each, percent)
    roots = common.stored(graph.components(links))
    live = common.stored(_mixed(bands, roots))
    doc_tiles = max(1, -(-live.select("a").distinct().count() // DOC_TILE))
    candidates = common.stored(_candidates(_met(live, heads), percent, doc_tiles))
    common.release_shuffles(spark)
    roots = graph.components(links.union(_compared(rows, candidates, words_each, percent)))

    placed = (classes.join(common.shuffled(roots), F.col("rep") == F.col("node"), "left")
              .select(F.col("key").alias("class_key"), F.coalesce("root", "rep").alias("component_id")))
    return (signed.drop("sketch").join(common.shuffled(placed), F.col("key") == F.col("class_key"), "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


OP12_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles
  FROM w),
u AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS t FROM s),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM u x JOIN u y ON x.t = y.t AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON s.doc_id = m.a
"""
