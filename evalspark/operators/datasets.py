"""Prompt datasets and file sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string


def content_id(*cols) -> Column:
    """deterministic id from natural-key columns (idempotent reloads, T18)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols]))


def literal_map(d: dict | None) -> Column:
    if not d:
        return F.create_map().cast("map<string,string>")
    items = []
    for k, v in d.items():
        items += [F.lit(str(k)), F.lit(str(v))]
    return F.create_map(*items)


def make_prompts(df: DataFrame, version: str, metadata: dict | None = None, created_at=None) -> DataFrame:
    """S3: prompt rows for ``version``; ids are content hashes of all that a
    row says when absent, so rows with one id are equal and count once.

    Per-row ``metadata`` (a map column) is kept and merged with the batch
    metadata (T17).
    """
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    truth = F.col("ground_truth") if "ground_truth" in df.columns else F.lit(None).cast("string")
    said = [F.col("prompt"), truth]
    if "metadata" in df.columns:
        said.append(F.to_json(F.array_sort(F.map_entries("metadata"))))
    made = F.col("prompt_id").isNull() if "prompt_id" in df.columns else F.lit(True)
    pid = content_id(F.lit(version), *said)
    if "prompt_id" in df.columns:
        pid = F.coalesce(F.col("prompt_id"), pid)
    meta = literal_map(metadata)
    if "metadata" in df.columns:
        own = F.coalesce(F.col("metadata"), F.create_map().cast("map<string,string>"))
        meta = F.map_concat(F.map_filter(meta, lambda k, _v: ~F.map_contains_key(own, k)), own)  # a row's own value stands
    out = df.select(
        pid.alias("prompt_id"), F.lit(version).alias("dataset_version"), F.col("prompt"),
        truth.alias("ground_truth"), meta.alias("metadata"), ts.alias("created_at"), ts.alias("updated_at"),
        # a given id is kept as it is: two rows with it are the caller's error, which the load reports
        F.when(made, F.lit(0)).otherwise(F.monotonically_increasing_id()).alias("_given"),
    )
    return out.dropDuplicates(["prompt_id", "_given"]).drop("_given")


def prompts_from_rows(spark: SparkSession, rows: list[dict], version: str, metadata: dict | None = None,
                      created_at=None) -> DataFrame:
    """S3: literal prompt rows (dicts with prompt, optional ground_truth,
    prompt_id, metadata) with an explicit schema, then ``make_prompts``."""
    schema = "prompt_id string, prompt string, ground_truth string, metadata map<string,string>"
    data = [(r.get("prompt_id"), r["prompt"], r.get("ground_truth"),
             {str(k): str(v) for k, v in (r.get("metadata") or {}).items()}) for r in rows]
    return make_prompts(spark.createDataFrame(data, schema), version, metadata, created_at)


def load_version(df: DataFrame, version: str, require_nonempty: bool = False) -> DataFrame:
    """P1 (+P15): rows of one dataset version; optionally fail when empty."""
    out = df.where(F.col("dataset_version") == version)
    if require_nonempty and out.isEmpty():
        raise ValueError(f"dataset version {version!r} has no rows")
    return out


def dataset_versions(df: DataFrame) -> DataFrame:
    """A1: one row per version with its size and time range."""
    return df.groupBy("dataset_version").agg(
        F.count(F.lit(1)).alias("prompt_count"),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
    )


def latest_version(df: DataFrame) -> DataFrame:
    """A2: the newest version (ties: greatest name) as exactly one row,
    NULLs when there are no rows: a global ``max_by`` over the per-version
    aggregate (no sort)."""
    order = F.struct(F.col("created_at"), F.col("dataset_version"))
    return dataset_versions(df).agg(
        F.max_by("dataset_version", order).alias("dataset_version"),
        F.max("created_at").alias("created_at"),
    )


def read_prompts(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    prompt_col: str = "prompt",
    truth_col: str | None = "ground_truth",
    schema=None,
    csv_escape: str = "\\",
    rejected_col: str | None = None,
) -> DataFrame:
    """Prompts from json, csv (with header) or parquet files; a
    missing truth column reads as NULL.

    csv fields may hold line breaks and quotes, escaped as Spark writes them;
    ``csv_escape='"'`` reads files that double their quotes. With
    ``rejected_col`` (json and csv) a record that cannot be read is kept: its
    text is in that column and its other columns are NULL.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("multiLine", "true").option("escape", csv_escape)
    if schema is not None or rejected_col is not None:
        given = schema if schema is not None else reader.load(path).schema
        fields = given if isinstance(given, StructType) else _parse_datatype_string(given)
        if rejected_col is not None and fmt != "parquet":
            fields = StructType([f for f in fields if f.name not in (rejected_col, "_corrupt_record")] + [StructField(rejected_col, StringType())])
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rejected_col)
        reader = reader.schema(fields)
    raw = reader.load(path)
    truth = F.col(truth_col) if truth_col and truth_col in raw.columns else F.lit(None).cast("string")
    cols = [F.col(prompt_col).cast("string").alias("prompt"), truth.cast("string").alias("ground_truth")]
    extra = [c for c in raw.columns if c not in (prompt_col, truth_col)]
    return raw.select(*cols, *extra)


def qa_to_prompts(qa: DataFrame, version: str, created_at=None) -> DataFrame:
    """Generated QA pairs as prompt rows; the chunk id and source
    travel in per-row metadata."""
    meta = F.create_map(F.lit("chunk_id"), F.col("chunk_id"), F.lit("source"), F.lit("testgen"))
    rows = qa.select(F.col("question").alias("prompt"), "ground_truth", meta.alias("metadata"))
    return make_prompts(rows, version, None, created_at)


SAMPLE_BITS = 16


def deterministic_sample(df: DataFrame, n: int, key: str) -> DataFrame:
    """L2/L4: a repeatable sample of ``n`` rows: the first ``n`` by md5 of
    the key, then the key, then the row as JSON (the limit is the feature). A
    NULL key counts as the empty text; equal rows may stand for each other.

    A histogram of the first 16 bits of the md5 (at most 65,536 rows) finds the
    bin in which the n-th row lies. Rows of earlier bins pass by a filter; only
    the rows of that bin are ordered, and of them only as many as are missing.
    """
    if n <= 0:
        return df.limit(0)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    bin_of = F.conv(F.substring(F.md5(text), 1, SAMPLE_BITS // 4), 16, 10).cast("int")
    bins = df.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    below = F.sum("rows").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    last = bins.withColumn("below", F.coalesce(below, F.lit(0))).where((F.col("below") < n) & (F.col("below") + F.col("rows") > n)).first()
    if last is None:  # the n-th row ends a bin, or there are no more rows
        last = bins.withColumn("upto", F.sum("rows").over(Window.orderBy("bin"))).where(F.col("upto") <= n).agg(F.max("bin")).first()[0]
        return df.where(bin_of <= last) if last is not None else df.limit(0)
    inside = df.where(bin_of == last["bin"]).orderBy(F.md5(text), F.col(key), F.to_json(F.struct(*df.columns))).limit(n - last["below"])
    return df.where(bin_of < last["bin"]).unionByName(inside)
