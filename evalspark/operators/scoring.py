"""Scores in the long eval_results format and the end-to-end evaluation
composition (K3, K11, F15, F19, F20, F21, F22, J1, A20)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.functions.text import nonempty, text_metrics
from evalspark.operators.datasets import content_id

# Metric names understood by the external scorer and the
# scorer each maps to; other names are skipped.
METRIC_TO_SCORER = {
    "answer_relevance": "RelevanceToQuery",
    "faithfulness": "RetrievalGroundedness",
    "relevance": "RelevanceToQuery",
    "correctness": "Correctness",
    "safety": "Safety",
}
DETERMINISTIC = ["rouge_l", "exact_match", "contains_match", "response_length", "token_count"]
SCORER_TAG = "mlflow_genai"
DETERMINISTIC_TAG = "deterministic"


def scorer_map():
    items = []
    for k, v in METRIC_TO_SCORER.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def mapped_metrics(df: DataFrame, metric_col: str = "metric_name") -> DataFrame:
    """rows whose metric has a scorer, with the scorer name; unknown
    metrics are dropped (so no NULL rows are written, T21)."""
    return df.withColumn("scorer", F.element_at(scorer_map(), F.col(metric_col))).where(F.col("scorer").isNotNull())


def join_prompts(responses: DataFrame, prompts: DataFrame) -> DataFrame:
    """Responses left-joined to their prompt text and truth; keyed on
    (prompt_id, dataset_version) when both sides carry the version (T6). A
    response without a version meets the newest version of its prompt, so one
    response is one row. A prompt answered far more often than others is
    split by AQE's skew join."""
    keys = ["prompt_id"] + (["dataset_version"] if "dataset_version" in responses.columns
                            and "dataset_version" in prompts.columns else [])
    p = prompts.select(*keys, "prompt", "ground_truth")
    if "dataset_version" in prompts.columns:
        order = F.struct(*[F.col(c) for c in ("created_at", "dataset_version") if c in prompts.columns])
        newest = prompts.groupBy("prompt_id").agg(F.max_by(F.struct("prompt", "ground_truth"), order).alias("_p")) \
            .select("prompt_id", "_p.prompt", "_p.ground_truth")
        if len(keys) == 1:
            p = newest
        else:
            p = p.unionByName(newest.withColumn("dataset_version", F.lit(None).cast("string")))
    r = responses.drop(*[c for c in ("prompt", "ground_truth") if c in responses.columns])
    pk = p.select(*[F.col(c).alias(f"_k_{c}") for c in keys], "prompt", "ground_truth")
    on = [F.col("prompt_id") == F.col("_k_prompt_id")]
    on += [F.col("dataset_version").eqNullSafe(F.col("_k_dataset_version"))] if len(keys) > 1 else []
    return r.join(pk, on, "left").drop(*[f"_k_{c}" for c in keys])


def to_long(
    wide: DataFrame,
    metrics: list[str],
    run_id: str,
    evaluator: str = DETERMINISTIC_TAG,
    created_at=None,
) -> DataFrame:
    """Wide metric columns -> one eval_results row per (row, metric)."""
    rid = F.col("response_id") if "response_id" in wide.columns else F.lit(None).cast("string")
    ver = F.col("dataset_version") if "dataset_version" in wide.columns else F.lit(None).cast("string")
    ids = wide.select(
        rid.alias("response_id"), "prompt_id", "model_version", ver.cast("string").alias("dataset_version"),
        *[F.col(m).cast("double").alias(m) for m in metrics],
    )
    long = ids.unpivot(["response_id", "prompt_id", "model_version", "dataset_version"], metrics, "metric_name", "metric_value")
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return long.select(
        content_id(F.lit(run_id), F.coalesce("response_id", "prompt_id"), "model_version", "metric_name")
        .alias("eval_id"),
        "response_id", "prompt_id", "model_version", F.lit(run_id).alias("run_id"),
        "metric_name", "metric_value", F.lit(None).cast("string").alias("metric_details"),
        F.lit(evaluator).alias("evaluator"), ts.alias("created_at"), "dataset_version",
    )


def eval_records(df: DataFrame, carry: dict | None = None) -> DataFrame:
    """evaluation records as nested structs, kept as a DataFrame;
    the columns of ``carry`` travel along."""
    truth = F.col("ground_truth")
    return df.select(
        F.struct(F.col("prompt").alias("question")).alias("inputs"),
        F.coalesce(F.col("response"), F.lit("")).alias("outputs"),
        F.struct(F.when(nonempty(truth), F.array(truth)).otherwise(F.array().cast("array<string>"))
                 .alias("expected_facts")).alias("expectations"),
        F.struct(F.col("prompt_id").alias("prompt_id")).alias("metadata"),
        *[c.alias(n) for n, c in (carry or {}).items()],
    )


def run_metric_summary(evals: DataFrame, run_id: str | None = None) -> DataFrame:
    """Count and mean per metric (and model) for one run."""
    df = evals if run_id is None else evals.where(F.col("run_id") == run_id)
    return df.groupBy("metric_name", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.avg("metric_value").alias("mean_value"))


def evaluate(
    responses: DataFrame,
    prompts: DataFrame,
    run_id: str,
    metrics: list[str] | None = None,
    created_at=None,
    partitions: int | None = None,
) -> DataFrame:
    """Responses -> J1 -> text metrics (F7) -> long rows (K3).

    ``partitions`` spreads the ROUGE-L work (rows are skewed by text length)
    before the Python UDF runs.
    """
    metrics = list(DETERMINISTIC if metrics is None else metrics)
    j = join_prompts(responses, prompts)
    if partitions:
        j = j.repartition(partitions)
    wide = text_metrics(j, rouge="rouge_l" in metrics)
    return to_long(wide, metrics, run_id, DETERMINISTIC_TAG, created_at)


def evaluate_run(
    responses: DataFrame,
    prompts: DataFrame,
    run_id: str,
    metrics: list[str] | None = None,
    judge: Callable | None = None,
    judge_endpoint: str | None = None,
    created_at=None,
    max_workers: int = 10,
) -> dict[str, DataFrame]:
    """K11 in full: ``evals`` are the text metrics (K3) and, with ``judge``,
    the judge scores (K2) as one long table; ``latency`` the statistics per
    model version (A3), NULL-free only where the responses carry a latency."""
    from evalspark.operators.batch import batch_judge
    from evalspark.operators.latency import latency_stats

    evals = evaluate(responses, prompts, run_id, metrics, created_at)
    if judge is not None:
        judged = batch_judge(join_prompts(responses, prompts), judge, judge_endpoint, run_id, created_at, max_workers)
        evals = evals.unionByName(judged.drop("reasoning"))
    out = {"evals": evals}
    if "latency_ms" in responses.columns:
        out["latency"] = latency_stats(responses)
    return out
