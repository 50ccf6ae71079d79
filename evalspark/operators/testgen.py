"""Retrieval-evaluation dataset building from document chunks (S4, K5, K7,
K8, J7-J9, J11, W5, L3, L4, A6-A8, A24, P12, P13, S11-S14, S17, F20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.operators.datasets import qa_to_prompts
from evalspark.operators.ranking import buckets_for, join_on_keys, smaller_weight
from evalspark.session import materialize
from evalspark.sources.store import KeyedTable, upsert_all

MIN_CHUNK_CHARS = 50
NEGATIVES_PER_QUERY = 2
UNKNOWN_CHUNK = "unknown"


def scan_chunks(
    chunks: DataFrame,
    id_col: str = "chunk_id",
    text_col: str = "source_text",
    min_chars: int = MIN_CHUNK_CHARS,
    filter_field: str | None = None,
    filter_value: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Chunks whose trimmed (and raw) text has at least
    ``min_chars`` characters, optionally equal on one payload field; the
    first ``limit`` by id only when asked for. The other payload fields become a string map."""
    df = chunks.where((F.length(F.trim(F.col(text_col))) >= min_chars) & (F.length(F.col(text_col)) >= min_chars))
    if filter_field and filter_value is not None:
        # a payload field is either a column or a key of a metadata map
        field = F.col(filter_field) if filter_field in chunks.columns \
            else F.element_at(F.col("metadata"), F.lit(filter_field))
        df = df.where(field == filter_value)
    payload = [c for c in chunks.columns if c not in (id_col, text_col)]
    items: list[Column] = []
    for c in payload:
        items += [F.lit(c), F.col(c).cast("string")]
    meta = F.create_map(*items) if items else F.create_map().cast("map<string,string>")
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), meta.alias("metadata"))
    if limit is not None:
        out = out.orderBy("id").limit(limit)
    return out


def hash_key(c) -> Column:
    """60-bit integer from md5 (reproducible in any SQL engine with md5)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(col), 1, 15), 16, 10).cast("bigint")


def hard_negatives(
    chunks: DataFrame,
    k: int = NEGATIVES_PER_QUERY,
    id_col: str = "chunk_id",
    doc_col: str = "source",
    buckets: int | None = None,
) -> DataFrame:
    """``k`` pseudo-random negatives per chunk, of other
    documents as long as there are any (T16), without comparing pairs.

    Chunks get exact positions ordered by (document hash, document, chunk
    hash, chunk), so a document of s chunks is one block [o, o + s). A chunk
    takes k consecutive places, from a place given by its own hash, among the
    n - s positions outside its block; only if those are fewer than k do the
    next chunks of its own document follow; chunks of another dataset version are
    none of these. That is k rows per chunk and one
    equi-join on position, for any document skew. A NULL document is a
    document of its own per chunk.

    Returns (chunk_id, rank, negative_chunk_id), rank 1..k, and dataset_version
    where the chunks have one.
    """
    versions = "dataset_version" in chunks.columns
    ver = F.col("dataset_version").cast("string") if versions else F.lit(None).cast("string")
    base = chunks.select(ver.alias("ver"), F.col(id_col).alias("id"), F.col(doc_col).cast("string").alias("doc")) \
        .where(F.col("id").isNotNull()).groupBy("ver", "id").agg(F.min("doc").alias("doc"))
    base = materialize(base.select("ver", "id", F.coalesce("doc", F.concat(F.lit("chunk:"), F.col("id").cast("string"))).alias("doc"),
                                   hash_key(F.col("id").cast("string")).alias("_h")))
    docs = materialize(base.groupBy("ver", "doc").agg(F.count(F.lit(1)).alias("s")).withColumn("_dh", hash_key("doc")))
    sizes = docs.groupBy("ver").agg(F.sum("s").alias("n"))
    n_docs, largest = docs.agg(F.count(F.lit(1)), F.max("s")).first()
    by_hash = docs.groupBy("ver", "_dh").agg(F.sum("s").alias("_hs"))
    offsets = smaller_weight(by_hash, ["ver"], "_dh", {"_before": "_hs"},
                             buckets=buckets_for(n_docs) if buckets is None else buckets)
    # equal 60-bit hashes (vanishingly rare) are ordered by the value itself
    tied = Window.partitionBy("ver", "_dh").orderBy("doc").rowsBetween(Window.unboundedPreceding, -1)
    offsets = join_on_keys(docs, offsets.select("ver", "_dh", "_before"), ["ver", "_dh"]).select(
        "ver", "doc", "s", (F.col("_before") + F.coalesce(F.sum("s").over(tied), F.lit(0))).alias("o"))
    hashes = base.groupBy("ver", "doc", "_h").agg(F.count(F.lit(1)).alias("_t"))
    inside = smaller_weight(hashes, ["ver", "doc"], "_h", {"_in": "_t"},
                            buckets=buckets_for(largest or 0) if buckets is None else buckets)
    tie = Window.partitionBy("ver", "doc", "_h").orderBy("id")
    ranked = join_on_keys(base, inside.select("ver", "doc", "_h", "_in"), ["ver", "doc", "_h"]) \
        .withColumn("i", F.col("_in") + F.row_number().over(tie) - 1)
    placed = join_on_keys(join_on_keys(ranked, offsets, ["ver", "doc"]), sizes, ["ver"])
    # both sides of the join below read the positions: write them once (also cuts lineage)
    pos = materialize(placed.select("ver", "id", "_h", "s", "o", "i", "n", (F.col("o") + F.col("i")).alias("pos")))
    outside = F.col("n") - F.col("s")
    j = F.col("rank") - 1
    place = F.pmod(F.col("_h") + j, outside)
    target = F.when(j < outside, F.when(place < F.col("o"), place).otherwise(place + F.col("s"))) \
        .otherwise(F.col("o") + F.pmod(F.col("i") + 1 + (j - outside), F.col("s")))
    src = pos.where("n > 1").select(
        F.col("id").alias("chunk_id"), "ver", "_h", "s", "o", "i", "n",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(k), (F.col("n") - 1).cast("int")))).alias("rank"),
    ).where("rank > 0").select("chunk_id", "ver", "rank", target.alias("target"))
    cand = pos.select("ver", F.col("pos").alias("target"), F.col("id").alias("negative_chunk_id"))
    out = join_on_keys(src, cand, ["ver", "target"])
    return out.select("chunk_id", "rank", "negative_chunk_id", *([F.col("ver").alias("dataset_version")] if versions else []))


def negatives_by_chunk(neg: DataFrame) -> DataFrame:
    """(chunk_id, [negative ids in rank order]), by dataset version where there
    are versions; at most k per chunk."""
    keys = [c for c in ("chunk_id", "dataset_version") if c in neg.columns]
    return neg.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "negative_chunk_id"))),
                    lambda s: s["negative_chunk_id"]).alias("hard_negative_chunk_ids"))


def qa_records(qa: DataFrame, chunks: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """QA rows with the chunk's payload map (default empty map)."""
    payload = [c for c in chunks.columns if c not in (id_col, "source_text")]
    items: list[Column] = []
    for c in payload:
        items += [F.lit(c), F.col(c).cast("string")]
    keys = _chunk_keys(qa, chunks, id_col)
    meta = chunks.select(*[F.col(c).alias(f"_c_{q}") for q, c in keys.items()], F.create_map(*items).alias("metadata"))
    if len(keys) == 1:  # pairs without a version: the newest version's payload, not an arbitrary one
        newest = F.struct(*[F.col(f"metadata")[c] for c in ("dataset_version",) if c in payload], F.to_json("metadata"))
        meta = meta.groupBy("_c_chunk_id").agg(F.max_by("metadata", newest).alias("metadata"))
    on = [qa[q].eqNullSafe(F.col(f"_c_{q}")) for q in keys]
    j = qa.join(meta, on, "left")
    return j.select("chunk_id", "question", "ground_truth", "source_text",
                    F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"))


def _chunk_keys(qa: DataFrame, chunks: DataFrame, id_col: str = "chunk_id") -> dict[str, str]:
    """QA column -> chunk column of the join key: the version belongs to it
    where both sides carry one (J7, J9)."""
    keys = {"chunk_id": id_col}
    if "dataset_version" in qa.columns and "dataset_version" in chunks.columns:
        keys["dataset_version"] = "dataset_version"
    return keys


def retrieval_records(qa: DataFrame, negatives: DataFrame) -> DataFrame:
    """{query, relevant_chunk_ids: [id], hard_negative_chunk_ids}."""
    if "dataset_version" not in qa.columns:
        negatives = negatives.drop("dataset_version")
    by = negatives_by_chunk(negatives)
    names = {c: f"_n_{c}" for c in ("chunk_id", "dataset_version") if c in by.columns}
    by = by.withColumnsRenamed(names)
    j = qa.join(by, [qa[c].eqNullSafe(F.col(n)) for c, n in names.items()], "left")
    return j.select(
        F.col("question").alias("query"),
        F.array(F.col("chunk_id")).alias("relevant_chunk_ids"),
        F.coalesce("hard_negative_chunk_ids", F.array().cast("array<string>")).alias("hard_negative_chunk_ids"),
    )


def rag_records(qa: DataFrame) -> DataFrame:
    """{question, contexts: [source_text], ground_truth}."""
    return qa.select("question", F.array(F.col("source_text")).alias("contexts"), "ground_truth")


def export(df: DataFrame, path: str, fmt: str = "json", partitions: int | None = None, rows_per_file: int = 1_000_000) -> str:
    """S11-S14 sink: JSON lines, csv (with header; fields may hold line breaks
    and quotes) or parquet files of at most ``rows_per_file`` rows under ``path``."""
    out = df.coalesce(partitions) if partitions else df
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        writer = writer.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    writer.format(fmt).save(path)
    return path


def qa_counts(qa: DataFrame) -> DataFrame:
    """QA pairs per chunk id (missing id -> 'unknown'), and per dataset
    version where the pairs carry one."""
    version = ["dataset_version"] if "dataset_version" in qa.columns else []
    return qa.groupBy(F.coalesce(F.col("chunk_id"), F.lit(UNKNOWN_CHUNK)).alias("chunk_id"), *version) \
        .agg(F.count(F.lit(1)).alias("qa_pairs_count"))


def chunk_rows(chunks: DataFrame, qa: DataFrame, version: str | None = None, created_at=None) -> DataFrame:
    """testgen_chunks rows; qa_pairs_count defaults to 0."""
    counts = qa_counts(qa)
    j = chunks.join(counts, list(_chunk_keys(qa, chunks)), "left")
    ts = F.col("created_at") if created_at is None and "created_at" in chunks.columns else (
        F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp"))
    ver = F.col("dataset_version") if version is None else F.lit(version)
    meta = F.create_map(F.lit("source"), F.col("source").cast("string")) if "source" in chunks.columns \
        else F.create_map().cast("map<string,string>")
    return j.select(
        "chunk_id", ver.alias("dataset_version"), "source_collection", "source_text",
        meta.alias("chunk_metadata"),
        F.coalesce(F.col("qa_pairs_count"), F.lit(0)).cast("int").alias("qa_pairs_count"),
        ts.alias("created_at"),
    )


def load_generated(prompt_table: KeyedTable, chunk_table: KeyedTable, chunks: DataFrame, qa: DataFrame, version: str,
                   created_at=None) -> None:
    """K7: the generated pairs as prompts of ``version`` and their chunks with
    pair counts, upserted as one load: both sources are checked (duplicate and
    NULL keys) before either table is written."""
    upsert_all([(prompt_table, qa_to_prompts(qa, version, created_at)), (chunk_table, chunk_rows(chunks, qa, created_at=created_at))])


def chunk_versions(rows: DataFrame) -> DataFrame:
    """Chunk and pair counts with time range per (version, collection)."""
    return rows.groupBy("dataset_version", "source_collection").agg(
        F.count(F.lit(1)).alias("chunk_count"),
        F.sum("qa_pairs_count").alias("total_qa_pairs"),
        F.min("created_at").alias("first_created"),
        F.max("created_at").alias("last_created"),
    )


def chunk_texts(rows: DataFrame, version: str) -> DataFrame:
    """(chunk_id, source_text) of one version."""
    return rows.where(F.col("dataset_version") == version).select("chunk_id", "source_text")


def generation_stats(rows: DataFrame, version: str | None = None) -> DataFrame:
    """Totals for one version (or all): chunks, pairs, average pairs
    per chunk and chunks without pairs; NULL sums read as 0."""
    df = rows if version is None else rows.where(F.col("dataset_version") == version)
    out = df.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.coalesce(F.sum("qa_pairs_count"), F.lit(0)).cast("long").alias("total_qa_pairs"),
        F.coalesce(F.avg("qa_pairs_count"), F.lit(0.0)).alias("avg_qa_per_chunk"),
        F.count_if(F.coalesce(F.col("qa_pairs_count"), F.lit(0)) == 0).alias("skipped_chunks"),
    )
    return out


def build_testset(chunks: DataFrame, gen, k: int = NEGATIVES_PER_QUERY, pairs_per_chunk: int = 3,
                  version: str | None = None, retries: int = 3, backoff_s: float = 1.0,
                  partitions: int | None = None, negatives: bool = True) -> dict[str, DataFrame]:
    """K4+K5+K7+K8 composition: generated QA pairs, hard negatives, the three
    export record sets, testgen_chunks rows and run totals (A24), all lazy.

    ``chunks`` needs chunk_id, source_text, source, source_collection,
    dataset_version and created_at (the ``chunks`` binding shape).
    """
    from evalspark.operators.batch import generate_qa

    # generate_qa writes its output once, every output below reads the written result
    generated = generate_qa(chunks, gen, pairs_per_chunk, retries, backoff_s, partitions=partitions)
    version_col = ["dataset_version"] if "dataset_version" in chunks.columns and version is None else []
    qa = generated.where(F.col("error").isNull() & F.col("question").isNotNull()) \
        .select("chunk_id", *version_col, "question", "ground_truth", "source_text")
    skipped = generated.where(F.col("error").isNotNull()).select("chunk_id", *version_col, "error", "attempts")
    rows = chunk_rows(chunks, qa, version)
    keys = ["chunk_id", *version_col]
    failed = skipped.select(*keys).distinct().withColumn("_failed", F.lit(True))
    totals = rows.join(failed, keys, "left").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.coalesce(F.sum("qa_pairs_count"), F.lit(0)).cast("long").alias("qa_pairs"),
        F.count_if(F.coalesce(F.col("_failed"), F.lit(False))).alias("skipped"),
    )
    out = {
        "qa": qa, "skipped": skipped, "qa_records": qa_records(qa, chunks), "rag": rag_records(qa),
        "chunk_rows": rows, "totals": totals,
    }
    if negatives:
        out["negatives"] = hard_negatives(chunks, k=k)
        out["retrieval"] = retrieval_records(qa, out["negatives"])
    return out
