"""Table schemas, enums and required columns for the six evaluation tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S = StringType()
D = DoubleType()
TS = TimestampType()
MSS = MapType(StringType(), StringType())

PROMPT_DATASETS = StructType([
    StructField("prompt_id", S, False),
    StructField("dataset_version", S, False),
    StructField("prompt", S, False),
    StructField("ground_truth", S, True),
    StructField("metadata", MSS, True),
    StructField("created_at", TS, True),
    StructField("updated_at", TS, True),
])

MODEL_RESPONSES = StructType([
    StructField("response_id", S, False),
    StructField("prompt_id", S, False),
    StructField("model_version", S, False),
    StructField("endpoint_name", S, True),
    StructField("response", S, True),
    StructField("latency_ms", D, True),
    StructField("status", S, True),
    StructField("error_message", S, True),
    StructField("created_at", TS, True),
    StructField("run_id", S, True),
    StructField("dataset_version", S, True),
])

EVAL_RESULTS = StructType([
    StructField("eval_id", S, False),
    StructField("response_id", S, True),
    StructField("prompt_id", S, True),
    StructField("model_version", S, True),
    StructField("run_id", S, True),
    StructField("metric_name", S, False),
    StructField("metric_value", D, True),
    StructField("metric_details", S, True),
    StructField("evaluator", S, True),
    StructField("created_at", TS, True),
    StructField("dataset_version", S, True),
])

METRIC_SUMMARY = StructType([
    StructField("summary_id", S, False),
    StructField("run_id", S, True),
    StructField("model_version", S, False),
    StructField("dataset_version", S, False),
    StructField("metric_name", S, False),
    StructField("metric_mean", D, True),
    StructField("metric_std", D, True),
    StructField("metric_p50", D, True),
    StructField("metric_p95", D, True),
    StructField("sample_size", LongType(), True),
    StructField("outcome", S, True),
    StructField("outcome_reason", S, True),
    StructField("baseline_version", S, True),
    StructField("baseline_mean", D, True),
    StructField("p_value", D, True),
    StructField("created_at", TS, True),
])

RUNS = StructType([
    StructField("run_id", S, False),
    StructField("job_id", S, True),
    StructField("job_run_id", S, True),
    StructField("status", S, True),
    StructField("config", S, True),
    StructField("task_state", S, True),
    StructField("outputs", S, True),
    StructField("created_at", TS, True),
    StructField("updated_at", TS, True),
    StructField("completed_at", TS, True),
])

TESTGEN_CHUNKS = StructType([
    StructField("chunk_id", S, False),
    StructField("dataset_version", S, False),
    StructField("source_collection", S, True),
    StructField("source_text", S, True),
    StructField("chunk_metadata", MSS, True),
    StructField("qa_pairs_count", IntegerType(), True),
    StructField("created_at", TS, True),
])

# Table name -> (schema, upsert key), one database per reference schema.
TABLES = {
    "raw.prompt_datasets": (PROMPT_DATASETS, ("prompt_id", "dataset_version")),
    "raw.model_responses": (MODEL_RESPONSES, ("response_id",)),
    "evaluated.eval_results": (EVAL_RESULTS, ("eval_id",)),
    "metrics.metric_summary": (METRIC_SUMMARY, ("summary_id", "metric_name")),
    "metadata.runs": (RUNS, ("run_id",)),
    "metadata.testgen_chunks": (TESTGEN_CHUNKS, ("chunk_id", "dataset_version")),
}

# Fixed values (labels and states used by the evaluation workflow).
OUTCOMES = ("PASS", "WARN", "FAIL")
RUN_STATUSES = ("pending", "running", "completed", "failed")
TASK_NAMES = ("init_catalog", "inference", "evaluation", "regression", "alert", "testgen")
TASK_STATUSES = ("pending", "running", "completed", "failed", "skipped")
