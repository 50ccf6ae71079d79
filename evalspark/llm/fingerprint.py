"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text's paragraphs (lines, cut further at sentence ends and after
``MOST_WORDS`` words) become 64-bit digests; the n-th repeat of a paragraph
gets a digest of its own, so a text is a set. Its fingerprint is a small
sketch: each digest is added to ``HASHES`` cells holding a count, the sum of
digests and the sum of check values (modulo 2^64). Two sketches subtract cell
by cell, whatever the texts share cancels, and peeling (take a cell with a
single digest left, remove that digest from its other cells, repeat) recovers
the differing digests. Where peeling stalls, both texts are sketched again
with twice the cells, up to a size at which even disjoint texts peel; a text
pair that still stalls there is compared by its digests directly.

Likeness is shared / all paragraphs (Jaccard), from the set sizes and the
number of recovered differences. All rows of a batch are sketched and peeled
together as numpy arrays.

The next document (descending id, after the last the first) needs an order
over the whole table: Spark's range partitioning of the ids alone finds ranges
of about as many rows each, every range is sorted on its own, and the first
document of each range is also sent to the range before it. One shuffle of the
texts; nothing is collected but one id per range.

Defined cases: NULL text is the empty text; two texts without paragraphs are
alike (1.0); NULL ids come last in the order, equal ids are ordered by their
text; repeated rows each get a result and are each other's next document; a
single row is its own next document; a very long text is sketched whole; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType

from . import common

CUT = re.compile(r"\n+|(?<=[.!?])\s+")
MOST_WORDS = 12
HASHES = 3
CELLS = 12
SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
CHECK = np.uint64(0xD6E8FEB86659FD93)
TEXT_SLICE = 3_000_000


def paragraphs(text: str) -> list[str]:
    out = []
    for part in CUT.split(text):
        words = part.split()
        if len(words) <= MOST_WORDS:
            if words:
                out.append(" ".join(words))
        else:
            out += [" ".join(words[i : i + MOST_WORDS]) for i in range(0, len(words), MOST_WORDS)]
    return out


def digests(text: str) -> np.ndarray:
    """Sorted distinct 64-bit digests of a text's paragraphs."""
    seen: dict[int, int] = {}
    out = []
    for p in paragraphs(text):
        d = xxhash.xxh3_64_intdigest(p.encode(errors="surrogatepass"))
        n = seen[d] = seen.get(d, 0) + 1
        out.append(d if n == 1 else xxhash.xxh3_64_intdigest(p.encode(errors="surrogatepass"), seed=n))
    return np.unique(np.array(out, dtype=np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _cells(d: np.ndarray, cells: int) -> list[np.ndarray]:
    """A cell in each third of the sketch."""
    part = cells // HASHES
    return [(_mix(d * seed) % np.uint64(part)).astype(np.int64) + k * part for k, seed in enumerate(SEEDS)]


def sketch(sets: list[np.ndarray], cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, digest sums and check sums, one row of ``cells`` per set."""
    d = np.concatenate([*sets, np.empty(0, np.uint64)])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets]) * cells
    count = np.zeros(len(sets) * cells, dtype=np.int64)
    total, check = np.zeros(len(count), dtype=np.uint64), np.zeros(len(count), dtype=np.uint64)
    own = _mix(d ^ CHECK)
    for at in _cells(d, cells):
        count += np.bincount(row + at, minlength=len(count))
        np.add.at(total, row + at, d)
        np.add.at(check, row + at, own)
    return tuple(a.reshape(len(sets), cells) for a in (count, total, check))


def peel(count: np.ndarray, total: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Differing digests per row of subtracted sketches; -1 where peeling stalls."""
    n, cells = count.shape
    count, total, check = count.ravel().copy(), total.ravel().copy(), check.ravel().copy()
    found = np.zeros(n, dtype=np.int64)
    live = np.flatnonzero(count | (total != 0))
    for _ in range(4 * cells + 8):
        sign = count[live]
        one = np.abs(sign) == 1
        at, sign = live[one], sign[one]
        d = np.where(sign > 0, total[at], np.uint64(0) - total[at])
        pure = np.where(sign > 0, check[at], np.uint64(0) - check[at]) == _mix(d ^ CHECK)
        at, sign, d = at[pure], sign[pure], d[pure]
        if not len(at):
            break
        row = at // cells
        _, first = np.unique(np.stack([row.astype(np.uint64), d]), axis=1, return_index=True)
        row, sign, d = row[first], sign[first], d[first]
        found += np.bincount(row, minlength=n)
        own = _mix(d ^ CHECK)
        for c in _cells(d, cells):
            where = row * cells + c
            np.subtract.at(count, where, sign)
            np.subtract.at(total, where, np.where(sign > 0, d, np.uint64(0) - d))
            np.subtract.at(check, where, np.where(sign > 0, own, np.uint64(0) - own))
        live = live[(count[live] != 0) | (total[live] != 0)]
    left = (count != 0) | (total != 0) | (check != 0)
    found[left.reshape(n, cells).any(axis=1)] = -1
    return found


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> np.ndarray:
    """Sizes of the symmetric differences, peeled from subtracted sketches."""
    out = np.full(len(a), -1, dtype=np.int64)
    todo = np.arange(len(a))
    limit = np.array([max(4 * cells, 6 * (len(x) + len(y))) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    while len(todo):
        # sketches of at most about a million cells at a time
        step = max(1, 1_000_000 // cells)
        for lo in range(0, len(todo), step):
            some = todo[lo : lo + step]
            x, y = sketch([a[i] for i in some], cells), sketch([b[i] for i in some], cells)
            out[some] = peel(*(p - q for p, q in zip(x, y, strict=True)))
        todo = todo[out[todo] < 0]
        cells *= 2
        for i in todo[cells > limit[todo]]:
            out[i] = len(np.setxor1d(a[i], b[i], assume_unique=True))
        todo = todo[out[todo] < 0]
    return out


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    size = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], dtype=np.float64)
    diff = differences(a, b)
    return np.where(size > 0, (size - diff) / np.maximum(size + diff, 1), 1.0)


def serialized(sets: list[np.ndarray], cells: int = CELLS) -> list[str]:
    """Set size and cells (count, digest sum, half of the check sum) as base 64."""
    count, total, check = sketch(sets, cells)
    packed = np.zeros((len(sets), cells), dtype=[("n", "<i4"), ("d", "<u8"), ("c", "<u4")])
    packed["n"], packed["d"], packed["c"] = count, total, check & np.uint64(0xFFFFFFFF)
    return [f"{len(s)}:{base64.b64encode(p.tobytes()).decode()}" for s, p in zip(sets, packed, strict=True)]


def _in_order(docs: DataFrame, range_rows: int, max_parts: int = 100_000) -> DataFrame:
    """id, text, part, extra: by descending id, part after part; the first
    rows of a part also come, marked extra, in the part before it (those of
    the first part in the last). Spark's range partitioning of the ids alone
    gives parts of about ``range_rows`` rows, however the ids are spaced; the
    largest id of each part is all that reaches the driver or is broadcast.
    Rows of one id, and those without one, are one part."""
    spark = docs.sparkSession
    whole = isinstance(docs.schema["id"].dataType, IntegralType)
    keyed = docs.withColumn("key", F.col("id").cast("long" if whole else "double"))
    n, without = docs.agg(F.count("id"), F.count_if(F.col("id").isNull())).first()
    parts = min(max_parts, max(1, -(-n // range_rows)))
    ranged = keyed.select("key").where("key is not null").repartitionByRange(parts, F.col("key").desc())
    found = ranged.select("key", F.spark_partition_id().alias("part")).groupBy("part").agg(F.max("key").alias("head")).collect()
    heads = sorted(r["head"] for r in found)
    last = len(heads) - (0 if without else 1)
    shared = spark.sparkContext.broadcast(np.array(heads, dtype=np.int64 if whole else np.float64))

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(len(shared.value) - 1 - np.searchsorted(shared.value, key.to_numpy()))

    part = F.when(F.col("key").isNull(), F.lit(len(heads))).otherwise(part_of(F.coalesce("key", F.lit(0).cast("long" if whole else "double"))))
    table = [(k, head, k - 1 if k else last) for k, head in enumerate([*reversed(heads), *([None] if without else [])])]
    places = spark.createDataFrame(table, f"part int, head {'long' if whole else 'double'}, before int")
    to = F.when(F.col("key").eqNullSafe(F.col("head")), F.col("before"))
    copies = F.filter(F.array(F.struct(F.col("part"), F.lit(False).alias("extra")),
                              F.struct(to.alias("part"), F.lit(True).alias("extra"))), lambda c: c["part"].isNotNull())
    return (keyed.withColumn("part", part).join(F.broadcast(places), "part").select("id", "text", F.explode(copies).alias("c"))
            .select("id", "text", "c.part", "c.extra"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int = 1_000) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and likenesses."""
    rows = common.pick(docs, id=id_col, text=text_col)
    placed = _in_order(rows, range_rows)
    spark = docs.sparkSession
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(ids: list, texts: list[str], nexts: list[str]) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 3] + x[: len(t) // 3] for t, x in zip(texts, nexts, strict=True)]
        own = [digests(t) for t in [*texts, nexts[-1]]]
        changed = [digests(t) for t in edited]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array(list(map(len, texts)), pa.int64()),
             pa.array([hashlib.sha256(t.encode(errors="surrogatepass")).hexdigest() for t in edited]),
             pa.array(serialized(own[:-1])), pa.array(serialized(changed)),
             pa.array(likeness(own[:-1], changed)), pa.array(likeness(own[:-1], own[1:]))], names)

    id_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (part, extra, id descending): a part's rows, then the row after its last."""
        ids: list = []
        texts: list[str] = []
        part, size, done = None, 0, False
        for batch in batches:
            for i, text, p, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    ids, texts, part, size, done = [], [], p, 0, False
                if done:
                    continue
                texts.append(text or "")
                size += len(texts[-1])
                if extra:  # of several first rows with one id, the first counts
                    yield finish(ids, texts[:-1], texts[1:])
                    done = True
                    continue
                ids.append(i)
                if size > TEXT_SLICE and len(texts) > 1:
                    yield finish(ids[:-1], texts[:-1], texts[1:])
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])

    common.ship(spark)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = (placed.repartition(n, "part").sortWithinPartitions("part", "extra", F.col("id").desc_nulls_last(), "text")
             .select("id", "text", "part", "extra"))
    schema = rows.select("id").schema
    for name, kind in (("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"),
                       ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")):
        schema = schema.add(name, kind)
    return dealt.mapInArrow(run, schema)


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(common.documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
