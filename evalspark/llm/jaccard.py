"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles; two link when their Jaccard similarity
is at least ``percent`` / 100. Exact, in these steps:

1. Equal sets collapse to one class (its smallest id stands for it), so a
   group of copies costs one document whatever its size. The same pass counts
   shingles in a fixed-size sketch over all documents; ordering shingles by
   (sketch count, digest) is the same order everywhere, rare ones first.
2. A linked pair shares at least L of the first n - ceil(t n) + L shingles of
   both, for every L. Each document picks its own L by estimated candidate
   cost: the sketch counts of its prefix, scanned once, plus verifying at
   most sum / L candidates. The prefix entries are dealt by shingle (one
   shuffle, packed arrays); shingles in one document only end there.
3. In each posting list every document is paired with the first one only; the
   most frequent such partner of each document is verified. The verified
   links already join most of every large near-duplicate group.
4. Posting lists that hold one component are done. The others give candidate
   pairs across components that share at least min(L, L') entries within that
   prefix length; documents compared with the same hub meet only where the hub
   does not explain what they share (see ``_candidates``). All candidates are
   verified. Pairs inside a component need no verification, so a group's pairs
   are never listed, yet no link between components is lost.

Defined cases: NULL text or a text without words is the empty set and links
with nothing; rows with the same id are one node; a NULL id stands for nothing
but keeps its row, in the component of its copies if it has any; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, graph
from .shingles import Words, shingle_sets

SKETCH_BITS = 20
CHUNK = 1 << 14
MOST_MATCHES = 4
ENTRY = np.dtype([("token", "<u8"), ("id", "<i8"), ("n", "<i4"), ("level", "<i2"), ("ell", "<i2")])
FLUSH = 1_500_000  # entries packed together
FOUND = "kind byte, token long, a long, b long, n int, level short, ell short"


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def signatures(rows: DataFrame, size: int) -> DataFrame:
    """id, n, key of every row's shingle set; and rows (chunk, counts) of the
    task's shingle counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = Words(), np.zeros(1 << SKETCH_BITS, dtype="<i4")
        for batch in batches:
            n, key = [], []
            for s in shingle_sets(batch.column(1).to_pylist(), size, words):
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.astype("<u8").tobytes()))
                np.add.at(counts, _slot(s), 1)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                                              pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names)
        chunks = [(i, c.tobytes()) for i, c in enumerate(counts.reshape(-1, CHUNK)) if c.any()]
        k = len(chunks)
        if k:
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
                                              pa.array([c[0] for c in chunks], pa.int32()), pa.array([c[1] for c in chunks])], names)

    names = ["id", "n", "key", "chunk", "counts"]
    common.ship(rows.sparkSession)
    return rows.mapInArrow(run, "id long, n long, key binary, chunk int, counts binary")


def sketch_counts(signed: DataFrame) -> np.ndarray:
    """All tasks' counts added up: 2^SKETCH_BITS numbers, whatever the input."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(counts, dtype="<i4").astype(np.int64)
                total[chunk] = total[chunk] + own if chunk in total else own
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()])],
                                             ["chunk", "counts"])

    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    parts = signed.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    for r in parts.mapInArrow(add, "chunk int, counts binary").collect():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] += np.frombuffer(r["counts"], dtype=np.int64)
    return out


def prefix(tokens: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The document's prefix, rare shingles first, and its L."""
    n = len(tokens)
    least = -(-percent * n // 100)  # shared shingles that a link needs at least
    frequency = counts[_slot(tokens)]
    order = np.lexsort((tokens, frequency))
    most = max(1, min(MOST_MATCHES, least))
    cost = np.cumsum(frequency[order][: n - least + most])
    verify = 1 + n / 64
    ell = min(range(1, most + 1), key=lambda m: cost[n - least + m - 1] * (1 + verify / m))
    return tokens[order[: n - least + ell]], ell


def _entries(rows: DataFrame, size: int, percent: int, counts: np.ndarray, buckets: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(counts)  # fixed size

    def dealt(parts: list[np.ndarray]) -> pa.RecordBatch:
        packed = np.concatenate(parts)
        bucket = (packed["token"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        packed, bucket = packed[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[edges], pa.int32()), pa.array([p.tobytes() for p in np.split(packed, edges[1:])], pa.binary())],
            ["bucket", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, held = Words(), [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, s in zip(ids, shingle_sets(batch.column(1).to_pylist(), size, words), strict=True):
                if not len(s):
                    continue
                tokens, ell = prefix(s, shared.value, percent)
                e = np.zeros(len(tokens), dtype=ENTRY)
                e["token"], e["id"], e["n"], e["ell"] = tokens, i, len(s), ell
                e["level"] = 1
                e["level"][len(tokens) - ell + 1 :] = np.arange(2, ell + 1)
                parts.append(e)
                held += len(e)
                if held >= FLUSH:
                    yield dealt(parts)
                    parts, held = [], 0
        if parts:
            yield dealt(parts)

    return rows.mapInArrow(run, "bucket int, packed binary").repartitionById(buckets, F.col("bucket"))


def _postings(dealt: DataFrame, percent: int) -> DataFrame:
    """kind 0: entries of shingles in several documents; kind 1: (a, b, n)
    documents a and the first document b of n shared posting lists."""
    def batch(kind: int, **columns: np.ndarray) -> pa.RecordBatch:
        k = len(columns["a"])
        kinds = {"token": pa.int64(), "a": pa.int64(), "b": pa.int64(), "n": pa.int32(), "level": pa.int16(), "ell": pa.int16()}
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, kind, dtype=np.int8)),
             *[pa.array(columns[c], t) if c in columns else pa.nulls(k, t) for c, t in kinds.items()]], ["kind", *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(p, dtype=ENTRY) for b in batches for p in b.column(1).to_pylist()]
        if not parts:
            return
        e = np.concatenate(parts)
        del parts
        e = e[np.lexsort((e["id"], e["token"]))]
        first = np.flatnonzero(np.diff(e["token"], prepend=~e["token"][:1]))
        size = np.diff(first, append=len(e))
        several = size > 1
        e = e[np.repeat(several, size)]
        size = size[several]
        if not len(e):
            return
        for lo in range(0, len(e), 200_000):
            p = e[lo : lo + 200_000]
            yield batch(0, token=p["token"].view(np.int64) if p["token"].flags.c_contiguous else p["token"].astype(np.int64),
                        a=p["id"], n=p["n"], level=p["level"], ell=p["ell"])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        hub = np.repeat(start, size)
        a, b = e["id"], e["id"][hub]
        fits = (a != b) & (100 * np.minimum(e["n"], e["n"][hub]).astype(np.int64) >= percent * np.maximum(e["n"], e["n"][hub]).astype(np.int64))
        a, b = a[fits], b[fits]
        if len(a):
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            first = np.flatnonzero((np.diff(a, prepend=a[0] - 1) != 0) | (np.diff(b, prepend=b[0]) != 0))
            yield batch(1, a=a[first], b=b[first], n=np.diff(first, append=len(a)))

    return dealt.mapInArrow(run, FOUND)


def compared(rows: DataFrame, pairs: DataFrame, size: int, percent: int, counts: np.ndarray | None = None) -> DataFrame:
    """Pairs (a, b) with their whole sets compared: linked, shared, n_a, n_b;
    with ``counts`` also core (the shingles of a's prefix that b has) and rest
    (how many of a's shingles are neither in b nor in a's prefix)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            s = [x.astype("<u8").tobytes() for x in shingle_sets(batch.column(1).to_pylist(), size, words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.binary())], ["id", "s"])

    shared_counts = rows.sparkSession.sparkContext.broadcast(counts)  # fixed size

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, n_a, n_b, core, rest = [], [], [], [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                both = np.intersect1d(x, y, assume_unique=True)
                shared.append(len(both))
                n_a.append(len(x))
                n_b.append(len(y))
                if counts is not None:
                    first = prefix(x, shared_counts.value, percent)[0]
                    common_first = np.intersect1d(first, both, assume_unique=True)
                    core.append(common_first.view(np.int64))
                    rest.append(len(x) - len(both) - (len(first) - len(common_first)))
                else:
                    core.append(None)
                    rest.append(None)
            k, n, m = (np.array(v, dtype=np.int64) for v in (shared, n_a, n_b))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(k * (100 + percent) >= percent * (n + m)), pa.array(k), pa.array(n), pa.array(m),
                 pa.array(core, pa.list_(pa.int64())), pa.array(rest, pa.int64())],
                ["a", "b", "linked", "shared", "n_a", "n_b", "core", "rest"])

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    found = common.stored(rows.join(common.shuffled(wanted), "id", "left_semi").mapInArrow(sets, "id long, s binary"))
    both = (pairs.join(common.shuffled(found.select(F.col("id").alias("a"), F.col("s").alias("s_a"))), "a")
            .join(common.shuffled(found.select(F.col("id").alias("b"), F.col("s").alias("s_b"))), "b").select("a", "b", "s_a", "s_b"))
    return both.mapInArrow(compare, "a long, b long, linked boolean, shared long, n_a long, n_b long, core array<long>, rest long")


def _suffixed(df: DataFrame, end: str, key: str) -> DataFrame:
    return df.toDF(*[c if c == key else c + end for c in df.columns])


def _candidates(entries: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that may be linked.

    ``entries``: token, a, n, level, ell, root, hub, core (the hub has the
    token too); ``stars``: a, hub, shared, n, rest, root, linked. Documents compared
    with the same hub share at most the smaller of what they share with it,
    plus what both have beside it. So such a pair is a candidate only if that
    smaller part (and the rest, shingles neither in the hub nor in the prefix)
    is enough, or if their prefixes share a shingle that the hub lacks; their
    entries of the hub's shingles never meet. Other pairs need min(L, L')
    shared entries.
    """
    entries = entries.withColumn("grp", F.when(F.col("core"), F.col("hub")))
    by_token = (entries.groupBy("token", "grp").agg(F.count("*").alias("k"), F.min("root").alias("lo"), F.max("root").alias("hi"))
                .groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max_by("grp", F.when(F.col("grp").isNotNull(), F.struct("k", "grp")))
                                      .alias("main"), F.count("*").alias("groups"), F.count_if(F.col("grp").isNull()).alias("loose")))
    mixed = by_token.where("lo <> hi and groups + loose > 1").select("token", "main")
    live = common.stored(entries.join(common.shuffled(mixed), "token").withColumn("minor", F.coalesce(F.col("grp") != F.col("main"), F.lit(True))).drop("main"))
    x, y = _suffixed(live.where("minor"), "_x", "token"), _suffixed(live, "_y", "token")
    same_hub = "hub_x <=> hub_y and hub_x is not null"
    met = x.join(common.shuffled(y), "token").where(
        f"root_x <> root_y and a_x <> a_y and (not minor_y or a_x < a_y) and not (grp_x <=> grp_y and grp_x is not null) "
        f"and 100L * least(n_x, n_y) >= {percent}L * greatest(n_x, n_y) "
        f"and (({same_hub}) or greatest(level_x, level_y) <= least(ell_x, ell_y))")
    pairs = (met.groupBy(F.least("a_x", "a_y").alias("a"), F.greatest("a_x", "a_y").alias("b"))
             .agg(F.count("*").alias("k"), F.min(F.when(F.expr(same_hub), 1).otherwise(F.least("ell_x", "ell_y"))).alias("ell"))
             .where("k >= ell").select("a", "b"))
    around = stars.groupBy("hub").agg(F.min("n").alias("least_n"), F.max("rest").alias("most_rest"))
    near = stars.where("not linked").join(around, "hub").where(
        f"(shared + greatest(rest, most_rest)) * {100 + percent}L >= {percent}L * (n + least_n)").drop("least_n", "most_rest", "linked")
    x, y = _suffixed(near, "_x", "hub"), _suffixed(stars.drop("linked"), "_y", "hub")
    close = x.join(y, "hub").where(
        f"root_x <> root_y and a_x <> a_y and 100L * least(n_x, n_y) >= {percent}L * greatest(n_x, n_y) "
        f"and (least(shared_x, shared_y) + greatest(rest_x, rest_y)) * {100 + percent}L >= {percent}L * (n_x + n_y)")
    return pairs.union(close.select(F.least("a_x", "a_y").alias("a"), F.greatest("a_x", "a_y").alias("b"))).distinct()


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75,
                      bucket_entries: int = 1_000_000) -> DataFrame:
    """Per row: id, n_shingles, component_id. Ids are integers."""
    spark = docs.sparkSession
    rows = common.pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    signed = common.stored(signatures(rows, size))
    sets = signed.where("chunk is null").select("id", "n", "key")
    counts = sketch_counts(signed)
    classes = common.stored(sets.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n")))
    n_entries = (classes.agg(F.sum("n")).first()[0] or 0) * (100 - percent) // 100
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_entries // bucket_entries))
    heads = rows.join(common.shuffled(classes.where("rep is not null").select(F.col("rep").alias("id")).distinct()), "id", "left_semi")
    postings = common.stored(_postings(_entries(heads, size, percent, counts, buckets), percent))
    common.release_shuffles(spark)
    stars = (postings.where("kind = 1").groupBy("a", "b").agg(F.sum("n").alias("n"))
             .groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b")))
    star = common.stored(compared(rows, common.stored(stars), size, percent, counts))
    near = star.where("linked").select("a", "b")
    roots = common.stored(graph.components(near))
    # a hub that was compared with no other is its own
    own = (star.select(F.col("b").alias("a"), F.col("n_b").alias("n")).distinct().join(star.select("a"), "a", "left_anti")
           .select("a", F.col("a").alias("hub"), F.col("n").alias("shared"), "n", F.lit(None).cast("array<long>").alias("core"),
                   F.lit(0).cast("long").alias("rest"), F.lit(True).alias("linked")))
    known = common.stored(star.select("a", F.col("b").alias("hub"), "shared", F.col("n_a").alias("n"), "core", "rest", "linked").union(own)
                          .join(roots, F.col("a") == F.col("node"), "left").withColumn("root", F.coalesce("root", "a")).drop("node"))
    entries = (postings.where("kind = 0").select("token", "a", "n", "level", "ell").join(common.shuffled(known.drop("n", "shared", "rest", "linked")), "a", "left")
               .select("token", "a", "n", "level", "ell", F.coalesce("root", "a").alias("root"), "hub",
                       (F.col("hub").isNotNull() & F.coalesce(F.array_contains("core", F.col("token")), F.lit(True))).alias("core")))
    pairs = common.stored(_candidates(entries, known.drop("core"), percent))
    common.release_shuffles(spark)
    more = common.stored(compared(rows, pairs, size, percent).where("linked").select("a", "b")) if pairs.limit(1).count() else pairs
    roots = graph.components(near.unionByName(more))
    placed = (classes.join(roots, F.col("rep") == F.col("node"), "left")
              .select(F.col("key").alias("class_key"), F.coalesce("root", "rep").alias("component_id")))
    return (sets.join(common.shuffled(placed), (F.col("key") == F.col("class_key")) & (F.col("n") > 0), "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(common.documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


OP8_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')))
                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles
  FROM w),
u AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS t FROM s),
e AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM u x JOIN u y ON x.t = y.t AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))),
r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, m.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON s.doc_id = m.a
"""
