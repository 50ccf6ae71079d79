"""Quality classifier: histogram gradient-boosted trees over document statistics.

Labels are joined to documents; the statistics of at most about
``train_rows`` labelled documents (a documented bound) train the trees, whose
split search works on per-feature histograms of quantile bins. The fitted
trees are flattened into arrays (feature, threshold, left, right, value) and
every document is scored in one narrow pass: statistics of the whole text,
then a vectorised traversal, all rows of a batch stepping down a tree at once.

Defined cases: NULL text counts as the empty text (all statistics 0) and gets
a score; labels that are NULL or not 0/1 are not learned; several labels of
one id count as their maximum; with no usable label every score is 0.5, with
one class only it is that class's smoothed rate; repeated rows are each
scored; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from . import common

SYMBOLS = "%&*#$|!?@/<>{}=_~^\\"
FEATURES = ("log_chars", "log_words", "log_lines", "mean_word", "longest_word", "distinct_words", "top_word",
            "repeated_neighbours", "upper_words", "capital_words", "short_words", "digits", "commas", "stops",
            "pipes", "bangs", "symbols", "most_symbols_in_line", "most_upper_in_line", "most_repeats_in_line",
            "most_pipes_in_line", "mean_line", "repeated_lines", "non_ascii", "bad_lines")


def statistics(text: str | None) -> list[float]:
    """The features of a whole text, in the order of FEATURES."""
    text = text or ""
    words = text.split()
    if not words:
        return [math.log1p(len(text))] + [0.0] * (len(FEATURES) - 1)
    lines = [x for x in text.split("\n") if x.strip()]
    n, chars = len(words), len(text)
    counts = Counter(words)
    lengths = list(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    worst = [0.0, 0.0, 0.0, 0.0]
    bad = 0
    for line in lines:
        own = line.split()
        k = len(own)
        parts = (sum(map(line.count, SYMBOLS)) / k, sum(map(str.isupper, own)) / k,
                 sum(map(eq, own, own[1:])) / k, line.count("|") / k)
        bad += max(parts) > 0.4
        if k >= 4:
            worst = list(map(max, worst, parts))
    return [math.log1p(chars), math.log1p(n), math.log1p(len(lines)), sum(lengths) / n, min(100, max(lengths)),
            len(counts) / n, max(counts.values()) / n, sum(map(eq, words, words[1:])) / n,
            sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n, sum(x <= 3 for x in lengths) / n,
            sum(map(text.count, "0123456789")) / chars, text.count(",") / n, text.count(".") / n, text.count("|") / n,
            text.count("!") / n, symbols / n, *worst,
            min(1e4, n / len(lines)), 1 - len(set(lines)) / len(lines), (len(text.encode(errors="replace")) - chars) / chars,
            bad / len(lines)]


@dataclass
class Trees:
    """All trees in flat arrays; node i's children are left[i] and right[i], a
    leaf points at itself. ``roots`` are the trees' first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
              ridge: float = 1.0, least_rows: int = 20) -> Trees:
    """Boosting with logistic loss; splits are searched on binned histograms."""
    flat: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1)
    base, roots = math.log(rate_of_ones / (1 - rate_of_ones)), []

    def node(value: float) -> int:
        i = len(flat["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", i), ("right", i), ("value", value)):
            flat[k].append(v)
        return i

    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            roots.append(node(0.0))
            level = [(roots[-1], np.arange(len(y)))]
            for d in range(depth + 1):
                below = []
                for at, rows in level:
                    g, h = grad[rows].sum(), hess[rows].sum()
                    flat["value"][at] = -rate * g / (h + ridge)
                    best = (1e-6, None)
                    if d < depth and len(rows) >= 2 * least_rows:
                        for f, e in enumerate(edges):
                            if not len(e):
                                continue
                            b = binned[rows, f]
                            hg, hh, hn = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (grad[rows], hess[rows], None))
                            gain = hg**2 / (hh + ridge) + (g - hg) ** 2 / (h - hh + ridge) - g**2 / (h + ridge)
                            gain[(hn < least_rows) | (len(rows) - hn < least_rows)] = 0
                            k = int(gain.argmax())
                            if gain[k] > best[0]:
                                best = (float(gain[k]), (f, k))
                    if best[1] is None:
                        margin[rows] += flat["value"][at]
                        continue
                    f, k = best[1]
                    goes_left = binned[rows, f] <= k
                    flat["feature"][at], flat["threshold"][at] = f, float(edges[f][k])
                    flat["left"][at], flat["right"][at] = node(0.0), node(0.0)
                    below += [(flat["left"][at], rows[goes_left]), (flat["right"][at], rows[~goes_left])]
                level = below
    arrays = {k: np.array(v if v else [0], dtype=float if k in ("threshold", "value") else np.int64) for k, v in flat.items()}
    return Trees(**arrays, roots=np.array(roots, dtype=np.int64), base=base if len(y) else 0.0, depth=depth)


def _features(docs: DataFrame) -> DataFrame:
    """Columns ``text`` and others -> the others and ``x``, the statistics."""
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(*kept).schema.add("x", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(x, pa.list_(pa.float64()))], [*kept, "x"])

    common.ship(docs.sparkSession)
    return docs.select(*kept, "text").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
        label_col: str = "quality", train_rows: int = 20_000, **options) -> Trees:
    """Trees from at most about ``train_rows`` labelled documents."""
    known = (common.pick(labels, label_id=label_id_col, label=label_col).where("label in (0, 1) and label_id is not null")
             .groupBy("label_id").agg(F.max("label").alias("label")))
    some = common.bounded_sample(known, F.col("label_id"), train_rows)  # bounded, so it may be broadcast
    rows = common.pick(docs, id=id_col, text=text_col)
    joined = rows.join(F.broadcast(some), F.col("id") == F.col("label_id")).select("id", "label", "text")
    found = sorted(_features(joined).collect(), key=lambda r: (r["id"], r["x"]))
    return fit_trees(np.array([r["x"] for r in found]).reshape(len(found), len(FEATURES)),
                     np.array([r["label"] for r in found], dtype=float), **options)


def with_scores(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score."""
    rows = common.pick(docs, id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()]).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["id", "score"])

    common.ship(docs.sparkSession)
    return rows.mapInArrow(run, rows.select("id").schema.add("score", "double"))


def op5_quality(spark: SparkSession, sf_dir: str, threshold: float = 0.7) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = fit(docs, labels.where(common.fold(F.col("doc_id"), 4) != 2))
    return with_scores(docs, trees).select(
        F.col("id").alias("doc_id"), (common.fold(F.col("id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
