"""Language ID by word-first backoff.

A known word scores by its log frequency in every language. An unseen word
falls back to its character n-grams: the longest size of which at least one
n-gram is known decides, down to single characters. A document's vector is the
sum over all its words, its prediction the best language, its score the
posterior of that sum tempered by the root of the word count. ``known`` is the
share of its words that are known or have a known n-gram; unlike the score it
does not depend on the number of languages.

The counts are fitted with Spark on a bounded sample of every language's
labelled rows (about ``train_rows`` of each, all of a language with no more),
so no language is lost as the corpus grows. The model keeps the ``max_words``
words and ``max_grams`` n-grams with the largest share in any one language, so
its size is bounded whatever the corpus (everything else is what the backoff
is for). The kept items are written as a table of that size and reach the
driver through Arrow as flat arrays; only tasks build dictionaries from them.
Prediction is one narrow pass over whole texts without a shuffle.

A word is a run of letters and numerals other than digits that holds a letter.

Defined cases: NULL text, empty text or text without a letter -> ``und``,
score 0, known 0; no labelled row -> every text ``und``; equal sums -> the language
that sorts first; repeated rows are each predicted; other columns are kept as
they are by ``with_language`` and never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
GRAM_SIZES = (5, 4, 3, 2, 1)
FLUSH = 50_000  # distinct words counted before they are sent on


@dataclass
class LanguageModel:
    """The first ``n_words`` items are words, the others n-grams."""

    langs: list[str]
    items: pa.StringArray
    n_words: int
    logs: np.ndarray  # one row of per-language log frequencies per item

    @cached_property
    def words(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.items[: self.n_words].to_pylist())}

    @cached_property
    def grams(self) -> dict[str, int]:
        return {g: i for i, g in enumerate(self.items[self.n_words :].to_pylist(), self.n_words)}


def words_of(text: str) -> list[str]:
    found = WORD.findall(text.lower())
    return found if "".join(found).isalpha() else [w for w in found if any(map(str.isalpha, w))]


def grams_of(word: str, size: int) -> list[str]:
    padded = f"^{word}$" if size > 1 else word
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per-task counts of (language, kind, item); kind 0 is a word, else the n-gram size."""
    words: dict[str, Counter] = {}

    def expanded() -> Iterator[pa.RecordBatch]:
        for lang, own in words.items():
            for kind in (0, *GRAM_SIZES):
                counts = own if kind == 0 else Counter()
                if kind:
                    for word, n in own.items():
                        for gram in grams_of(word, kind):
                            counts[gram] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang), len(counts)), pa.repeat(pa.scalar(kind, pa.int32()), len(counts)),
                     pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "kind", "item", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, words.values())) > FLUSH:
                yield from expanded()
                words.clear()
    yield from expanded()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_rows: int = 5_000, max_words: int = 60_000, max_grams: int = 80_000, alpha: float = 0.5) -> LanguageModel:
    """Fit on at most about ``train_rows`` rows of each language, with a text."""
    rows = common.pick(docs, id=id_col, text=text_col, lang=lang_col).where("text is not null and lang is not null")
    sample = common.bounded_sample_by(rows, "lang", F.col("id"), train_rows).select("lang", "text")
    common.ship(docs.sparkSession)
    counts = common.stored(sample.mapInArrow(_count, "lang string, kind int, item string, n long")
                           .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    totals = {(r["lang"], r["kind"]): (r["n"], r["v"])
              for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    langs = sorted({lang for lang, _ in totals})
    place = {lang: i for i, lang in enumerate(langs)}
    sums = docs.sparkSession.createDataFrame([(lang, kind, place[lang], n) for (lang, kind), (n, _) in totals.items()],
                                             "lang string, kind int, place int, whole long")
    by_item = (counts.join(F.broadcast(sums), ["lang", "kind"]).groupBy("kind", "item")
               .agg(F.max(F.col("n") / F.col("whole")).alias("share"), F.collect_list(F.struct("place", "n")).alias("by_lang")))

    def top(kind_test: str, limit: int) -> pa.Table:
        """Chosen and written by tasks: the driver gets no more than ``limit`` flat rows."""
        best = by_item.where(kind_test).orderBy(F.desc("share"), "kind", "item").limit(limit)
        return common.stored(best.select("kind", "item", "by_lang")).toArrow()

    words, grams = top("kind = 0", max_words), top("kind > 0", max_grams)
    known = pa.concat_tables([words, grams])
    bottom = np.array([[alpha / (n + alpha * (v + 1)) for n, v in (totals.get((lang, kind), (0, 0)) for lang in langs)]
                       for kind in range(max(GRAM_SIZES) + 1)])
    p = bottom[known["kind"].to_numpy()]
    lists = known["by_lang"].combine_chunks()
    entries = lists.flatten()
    p[np.repeat(np.arange(len(p)), lists.value_lengths().to_numpy()), entries.field("place").to_numpy()] *= (
        entries.field("n").to_numpy() + alpha) / alpha
    return LanguageModel(langs, known["item"].combine_chunks(), words.num_rows, np.log(p).astype(np.float32))


def scorer(model: LanguageModel, remembered: int = 100_000) -> Callable[[str | None], tuple[str, float, float]]:
    """A function from a whole text to (language, score, known). Backoff vectors of
    up to ``remembered`` unseen words are kept between calls."""
    n_langs, base = len(model.langs), len(model.logs)
    logs = np.zeros((base + remembered, max(1, n_langs)), dtype=np.float32)
    logs[:base, :n_langs] = model.logs
    index = dict(model.words)

    strange = np.zeros(len(logs), dtype=bool)  # remembered words without a known n-gram

    def backoff(word: str) -> tuple[np.ndarray, bool]:
        for size in GRAM_SIZES:
            known = [g for g in map(model.grams.get, grams_of(word, size)) if g is not None]
            if known:
                return model.logs[known].mean(axis=0), False
        return np.zeros(n_langs, dtype=np.float32), True

    used = base

    def score(text: str | None) -> tuple[str, float, float]:
        nonlocal used, index
        counts = Counter(words_of(text)) if text and n_langs else None
        if not counts:
            return UNDETERMINED, 0.0, 0.0
        total = np.zeros(n_langs)
        unknown = 0
        known: list[int] = []
        times: list[int] = []
        for word, n in counts.items():
            i = index.get(word)
            if i is None:
                vector, none = backoff(word)
                unknown += n * none
                if used < len(logs):
                    logs[used], strange[used] = vector, none
                    index[word] = used
                    used += 1
                else:  # remembered words start anew
                    index, used = dict(model.words), base
                total += n * vector.astype(np.float64)
            else:
                known.append(i)
                times.append(n)
        if known:
            total += np.array(times, dtype=np.float64) @ logs[known]
            unknown += int(np.array(times) @ strange[known])
        n_words = sum(counts.values())
        tempered = total / np.sqrt(n_words)
        p = np.exp(tempered - tempered.max())
        best = int(total.argmax())
        return model.langs[best], float(p[best] / p.sum()), 1 - unknown / n_words

    return score


def language_column(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """struct<lang string, score double, known double> for a text column."""
    common.ship(spark)
    shared = spark.sparkContext.broadcast(model)  # at most max_words + max_grams rows

    @F.pandas_udf("lang string, score double, known double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame([score(t) for t in texts], columns=["lang", "score", "known"])

    return predict(text)


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_as: str = "lang_pred",
                  score_as: str = "lang_score") -> DataFrame:
    """``docs`` with two more columns; names already taken get a numbered suffix."""
    found = common.fresh(docs, "language_found")
    lang_as = common.fresh(docs, lang_as)
    out = docs.withColumn(found, language_column(docs.sparkSession, model, common.col(text_col)))
    score_as = common.fresh(out, score_as)
    return out.select(*[common.col(c) for c in docs.columns], F.col(found)["lang"].alias(lang_as),
                      F.col(found)["score"].alias(score_as))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = common.fold(F.col("doc_id"), 5) == 0
    model = fit(docs.where(~held_out))
    found = language_column(spark, model, F.col("text"))
    return (docs.select("doc_id", held_out.alias("held_out"), found.alias("found"))
            .select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")))
