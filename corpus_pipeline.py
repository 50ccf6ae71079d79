"""From raw documents to packed training sequences, in five written stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes every stage's result to the shared folder and reads it
back as the next one's input. All but the last return the columns of
``documents``, whatever further columns those carry.

1. language_id      texts without a letter go, and those of which fewer than
                    half of the words are known, or have a known n-gram, in
                    any of the learned languages
2. near_duplicates  of every group of texts linked at Jaccard 0.75 over word
                    five-grams the one with the smallest id stays
3. decontamination  texts that hold a benchmark item within a quarter of its
                    words in edit distance go
4. pii              personal data are replaced by their kind; n_chars follows
5. packing          token sequences of at most 1024, best-two-fit

Defined cases: NULL and empty texts have no letter and go in stage 1; where no
row has a language to learn from, stage 1 keeps every row; rows that share id
and text are one document in stage 2; rows whose id has several texts are told
apart by id and text and give way to those with an id of their own, among
themselves to one that is the same on every run; rows with a NULL id are told
apart by their text and give way to all others; an empty table passes through all
stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.llm import common, decontam, jaccard, langid, packing, pii

LEAST_KNOWN_WORDS = 0.5  # a share of the words: does not depend on the number of languages


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    if not model.langs:
        return docs
    found = common.fresh(docs, "language")
    judged = docs.withColumn(found, langid.language_column(spark, model, F.col("text")))
    kept = (F.col(found)["lang"] != langid.UNDETERMINED) & (F.col(found)["known"] >= LEAST_KNOWN_WORDS)
    return judged.where(kept).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    node = common.fresh(docs, "node")
    beyond = F.lit((1 << 62) + (1 << 61)) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    nodes = docs.withColumn(node, F.coalesce(F.col("doc_id").cast("long"), beyond))
    digest = F.xxhash64("text")
    mixed = common.stored(docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias(node))
                          .agg(F.min(digest).alias("a"), F.max(digest).alias("b")).where("a <> b").select(node))
    if mixed.limit(1).count():
        several = common.fresh(nodes, "several")
        own = F.lit(1 << 62) + F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 61))
        nodes = common.stored(nodes.join(common.shuffled(mixed.withColumn(several, F.lit(True))), node, "left")
                              .withColumn(node, F.when(F.col(several), own).otherwise(F.col(node))).select(*map(common.col, docs.columns), node))
    groups = jaccard.linked_components(nodes, id_col=node)
    first = groups.where("id = component_id").select(F.col("id").alias(node)).distinct()
    return nodes.join(common.shuffled(first), node, "left_semi").dropDuplicates([node]).drop(node)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = common.stored(packing.token_pieces(docs, **packing.public_vocabulary()))
    return packing.pack(pieces).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", best_fit_packing),
]

# SQL cannot express the stages (trained language model, tokenizer, packing);
# tests/llm compares run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.stored(docs)
            common.release_shuffles(spark)
    return docs
