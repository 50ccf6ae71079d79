"""Divergence of the sources of each language, in exact integers.

1. An Arrow pipeline inside ``mapInArrow`` (``ascii_lower``,
   ``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``) turns texts
   into partial counts: occurrences and documents of a term per (lang, source).
   What a task holds is bounded; full tables are sent on.
2. Spark adds the partial counts up, first per (lang, source, term), then per
   (lang, term): a term that every document has is one row per source by then.
   Terms in at least ``least_docs`` documents of the lang are kept and stored,
   one row a term with its counts by source: the merged columnar shards.
3. With N and V known, a count becomes a share p in parts per 10^9. A pair of
   sources (g, h) sums f(p, q) = floor((p - q)^2 / q) over all kept terms. Most
   terms are in few sources, so the sum is taken apart: terms in neither are
   one product, terms in one depend on a count only (a histogram per source),
   and only terms in both are looked at pair by pair, by numpy over the shards.

The parts with the highest f over the lang's own share are listed per source.

Defined cases: NULL text, lang or source is the empty one; an empty text has no
term but its (lang, source) is there; repeated rows count each; equal values
rank by the UTF-8 bytes of the item; a lang with no kept term has sums of 0; an
empty table gives an empty result; a text is always counted whole, however
long; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
TEXT_SLICE = 2_000_000
HELD_ROWS = 400_000  # partial counts that a task holds
PAIR_BLOCK = 1_000_000
SHARE = 1_000_000_000
KEYS = ["lang", "source", "term"]


def _counted(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """lang, source, term, n, docs of some rows."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), NO_TERM)
    row, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    some = pc.not_equal(term, "")
    row, term = row.filter(some), pc.dictionary_encode(term.filter(some))
    found = pa.table({"row": row, "term": term.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    lang, source = pc.dictionary_encode(lang), pc.dictionary_encode(source)
    at = found["row"].combine_chunks()
    grouped = (pa.table({"lang": lang.indices.take(at), "source": source.indices.take(at), "term": found["term"], "k": found["count_all"]})
               .group_by(KEYS, use_threads=False).aggregate([("k", "sum"), ("k", "count")]))
    return pa.table({"lang": lang.dictionary.take(grouped["lang"].combine_chunks()), "source": source.dictionary.take(grouped["source"].combine_chunks()),
                     "term": term.dictionary.take(grouped["term"].combine_chunks()), "n": grouped["k_sum"], "docs": grouped["k_count"]})


def partial_counts(rows: DataFrame) -> DataFrame:
    """rows: lang, source, text without NULLs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = least = 0
        for batch in batches:
            lang, source, text = (c.cast(pa.string()) for c in batch.columns)
            lengths = pc.binary_length(text).to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(lengths):
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(lengths[lo:]), TEXT_SLICE)) + lo)
                held.append(_counted(lang[lo:hi], source[lo:hi], text[lo:hi]))
                size += held[-1].num_rows
                lo = hi
                if size > least + HELD_ROWS:
                    held = [_merged(held)]
                    size = least = held[0].num_rows
                    if size > HELD_ROWS:
                        yield from held[0].to_batches()
                        held, size, least = [], 0, 0
        if held:
            yield from _merged(held).to_batches()

    common.ship(rows.sparkSession)
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _merged(held: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(held).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return table.select([*KEYS, "n_sum", "docs_sum"]).rename_columns([*KEYS, "n", "docs"])


def kept_terms(rows: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, total, by_source: array of (source, n)."""
    merged = partial_counts(rows).groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (merged.groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("by_source"))
            .where(F.col("docs") >= least_docs).drop("docs"))


def _share(count: str, total: str) -> Column:
    return F.expr(f"1 + (cast({SHARE} as decimal(10,0)) * cast({count} + 1 as decimal(20,0))) div cast({total} + v as decimal(20,0))")


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div ({q})"


def _f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared_sums(shares: DataFrame) -> DataFrame:
    """lang, source, item, value: over the terms of both sources, f of their
    shares less what the sums over one source and over no source count for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.list_flatten(lists)
            lang = pc.dictionary_encode(batch.column(0).cast(pa.string()))
            source = pc.dictionary_encode(flat.field("source").cast(pa.string()))
            p, none = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("p", "none"))
            group = np.repeat(lang.indices.to_numpy().astype(np.int64), sizes) * len(source.dictionary) + source.indices.to_numpy()
            of = np.repeat(np.arange(len(sizes)), sizes)
            left = np.cumsum(sizes)[of]  # end of the term's entries
            begin = left - sizes[of]
            pairs = np.concatenate([[0], np.cumsum(sizes[of])])  # pairs up to an entry
            lo = 0
            while lo < len(of):
                hi = max(lo + 1, int(np.searchsorted(pairs, pairs[lo] + PAIR_BLOCK, side="right")) - 1)
                x = np.repeat(np.arange(lo, hi), sizes[of[lo:hi]])
                y = np.arange(len(x)) - (pairs[x] - pairs[lo]) + begin[x]
                x, y = x[x != y], y[x != y]
                lo = hi
                if not len(x):
                    continue
                value = _f_of(p[x], p[y]) - _f_of(p[x], none[y]) - _f_of(none[x], p[y]) + _f_of(none[x], none[y])
                order = np.lexsort((group[y], group[x]))
                x, y, value = x[order], y[order], value[order]
                new = np.flatnonzero(np.concatenate([[True], (np.diff(group[x]) != 0) | (np.diff(group[y]) != 0)]))
                x, y = x[new], y[new]
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(group[x] // len(source.dictionary))), source.dictionary.take(source.indices.take(pa.array(x))),
                     source.dictionary.take(source.indices.take(pa.array(y))), pa.array(np.add.reduceat(value, new))],
                    ["lang", "source", "item", "value"])

    return shares.mapInArrow(run, "lang string, source string, item string, value long")


def divergences(docs: DataFrame, least_docs: int = 3, most_terms: int = 200, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    rows = common.pick(docs, lang=lang_col, source=source_col, text=text_col).select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    terms = common.stored(kept_terms(rows, least_docs))
    common.release_shuffles(docs.sparkSession)
    counts = terms.select("lang", "term", "total", F.inline("by_source"))
    by_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_source"), F.count("*").alias("k"))
    by_lang = terms.groupBy("lang").agg(F.sum("total").alias("n_lang"), F.count("*").alias("v"))
    groups = common.stored(
        rows.select("lang", "source").distinct().join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
        .na.fill(0, ["n_source", "k", "n_lang", "v"]).withColumn("none", F.when(F.col("v") > 0, _share("0", "n_source")).otherwise(0)))
    shares = common.stored(counts.join(groups, ["lang", "source"])
                           .select("lang", "source", "term", _share("n", "n_source").alias("p"), "none", _share("total", "n_lang").alias("q")))

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term = (shares.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most_terms))

    wide = "decimal(38,0)"
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("none_item"), F.col("k").alias("k_item"))
    single = (shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times")).join(other, "lang").where("source <> item")
              .select("lang", F.inline(F.expr(f"array(struct(source as source, item as item, cast(times * ({_f('p', 'none_item')}) as {wide}) as value), "
                                              f"struct(item as source, source as item, cast(times * ({_f('none_item', 'p')}) as {wide}) as value))"))))
    both = _shared_sums(shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "none")).alias("s")).select("lang", "s"))
    neither = (groups.join(other, "lang").where("source <> item")
               .select("lang", "source", "item", F.expr(f"if(v = 0, 0, cast(v - k - k_item as {wide}) * ({_f('none', 'none_item')}))").cast(wide).alias("value")))
    pair = (single.union(both.select("lang", "source", "item", F.col("value").cast(wide))).union(neither)
            .groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
            .withColumn("rank", F.row_number().over(ranked)))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair.withColumn("part", F.lit("pair")).select(*columns).union(term.withColumn("part", F.lit("term")).select(*columns))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(common.documents(spark, sf_dir))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
o AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
t AS (SELECT lang, term, count(*)::HUGEINT AS total FROM o GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
c AS (SELECT o.lang, o.source, o.term, count(*)::HUGEINT AS n FROM o JOIN t USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, sum(total)::HUGEINT AS n_lang, count(*)::HUGEINT AS v FROM t GROUP BY lang),
g AS (
  SELECT s.lang, s.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = s.lang AND c.source = s.source), 0)::HUGEINT AS n_source
  FROM (SELECT DISTINCT lang, source FROM d) s),
p AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n_source + l.v) AS p,
         1 + 1000000000::HUGEINT * (t.total + 1) // (l.n_lang + l.v) AS q
  FROM g JOIN l USING (lang) JOIN t USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
pairs AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p)::HUGEINT AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
k AS (
  SELECT lang, source, part, item, value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM r)
SELECT * FROM k WHERE part = 'pair' OR rank <= 200
"""
