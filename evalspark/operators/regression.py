"""Regression outcome between two model versions.

The whole report is one DataFrame plan: long evals -> per-metric comparison
-> outcome. Only one row per requested metric is produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evalspark.operators.stats import count_facts, mann_whitney_columns, pct_change_signed, rank_summary, value_counts
from evalspark.session import materialize

# Default metrics, thresholds and alert labels of the workflow.
DEFAULT_METRICS = ["faithfulness", "answer_relevance", "judge_score", "rouge_l", "latency_p95"]
THRESHOLD_PCT = 5.0
P_VALUE_THRESHOLD = 0.05
ALERT_LABELS = ("WARN", "FAIL")
INSUFFICIENT = "Insufficient data"


def _requested(spark: SparkSession, metrics: list[str]) -> DataFrame:
    """The requested metric list as a tiny frame (bounded by the argument)."""
    return spark.createDataFrame([(m, i) for i, m in enumerate(metrics)], "metric_name string, metric_order int")


def is_regression_col(metric, pct, p, threshold_pct: float, alpha: float):
    """Latency metrics regress upwards, all others downwards."""
    latency = F.lower(metric).contains("latency")
    up = (pct > threshold_pct) & (p < alpha)
    down = (pct < -threshold_pct) & (p < alpha)
    return F.when(latency, up).otherwise(down)


def compare_metrics(
    evals: DataFrame,
    candidate: str,
    baseline: str,
    metrics: list[str] | None = None,
    candidate_run: str | None = None,
    baseline_run: str | None = None,
    threshold_pct: float = THRESHOLD_PCT,
    alpha: float = P_VALUE_THRESHOLD,
    buckets: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """One comparison row per requested metric.

    A metric with no values on either side gets reason 'Insufficient data'
    and NULL statistics (NULLs stay NULL, T3).
    """
    spark = evals.sparkSession
    metrics = list(DEFAULT_METRICS if metrics is None else metrics)
    counts = materialize(value_counts(evals, candidate, baseline, metrics, candidate_run, baseline_run))
    auto, needs_exact = count_facts(counts)
    summary = rank_summary(counts, buckets=auto if buckets is None else buckets, percentiles=True,
                           materialize_counts=False)
    s = mann_whitney_columns(summary, exact=exact and needs_exact)
    s = s.withColumn("pct_change", pct_change_signed(F.col("candidate_mean"), F.col("baseline_mean")))
    s = s.withColumn("is_regression",
                     is_regression_col(F.col("metric_name"), F.col("pct_change"), F.col("p_value"),
                                       threshold_pct, alpha))
    enough = (F.col("n1") > 0) & (F.col("n2") > 0)
    req = _requested(spark, metrics)
    # s has at most one row per requested metric (evals were filtered to the
    # list): a broadcast bounded by the argument, not by the data
    j = req.join(F.broadcast(s), "metric_name", "left")
    keep = lambda c: F.when(enough, c)
    return j.select(
        "metric_name",
        keep(F.col("candidate_mean")).alias("candidate_mean"),
        keep(F.col("baseline_mean")).alias("baseline_mean"),
        keep(F.col("candidate_std")).alias("candidate_std"),
        keep(F.col("baseline_std")).alias("baseline_std"),
        keep(F.col("candidate_p50")).alias("candidate_p50"),
        keep(F.col("candidate_p95")).alias("candidate_p95"),
        keep(F.col("pct_change")).alias("pct_change"),
        keep(F.col("u_statistic")).alias("u_statistic"),
        keep(F.col("z_score")).alias("z_score"),
        keep(F.col("p_value")).alias("p_value"),
        keep(F.col("is_regression")).alias("is_regression"),
        F.coalesce(F.col("n1"), F.lit(0)).cast("long").alias("n_candidate"),
        F.coalesce(F.col("n2"), F.lit(0)).cast("long").alias("n_baseline"),
        F.when(~F.coalesce(enough, F.lit(False)), F.lit(INSUFFICIENT)).alias("reason"),
        "metric_order",
    )


def outcome_of(comparisons: DataFrame, threshold_pct: float = THRESHOLD_PCT) -> DataFrame:
    """PASS without regressions; FAIL when any regression moves more than
    twice the threshold; otherwise WARN. One row."""
    reg = F.coalesce(F.col("is_regression"), F.lit(False))
    return comparisons.agg(
        F.count_if(reg).alias("n_regressions"),
        F.count_if(reg & (F.abs(F.coalesce(F.col("pct_change"), F.lit(0.0))) > 2 * threshold_pct)).alias("n_severe"),
        F.count(F.lit(1)).alias("n_metrics"),
    ).withColumn(
        "outcome",
        F.when(F.col("n_regressions") == 0, "PASS").when(F.col("n_severe") > 0, "FAIL").otherwise("WARN"),
    )


def regression_report(
    evals: DataFrame,
    candidate: str,
    baseline: str,
    metrics: list[str] | None = None,
    candidate_run: str | None = None,
    baseline_run: str | None = None,
    threshold_pct: float = THRESHOLD_PCT,
    alpha: float = P_VALUE_THRESHOLD,
    run_id: str | None = None,
    dataset_version: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """K6: comparison rows with the overall outcome attached to each row.

    The outcome is computed with a window over the comparison rows (one per
    requested metric), so the plan never leaves Spark and no join is needed.
    """
    comp = compare_metrics(evals, candidate, baseline, metrics, candidate_run, baseline_run,
                           threshold_pct, alpha, buckets)
    # The comparison frame has one row per requested metric, so a window over
    # all of it is bounded by the argument list, not by the data.
    w = Window.partitionBy()
    reg = F.coalesce(F.col("is_regression"), F.lit(False))
    severe = reg & (F.abs(F.coalesce(F.col("pct_change"), F.lit(0.0))) > 2 * threshold_pct)
    out = comp.withColumn("n_regressions", F.count_if(reg).over(w)) \
              .withColumn("_n_severe", F.count_if(severe).over(w))
    out = out.withColumn(
        "outcome",
        F.when(F.col("n_regressions") == 0, "PASS").when(F.col("_n_severe") > 0, "FAIL").otherwise("WARN"),
    )
    return out.select(
        F.lit(candidate).alias("candidate_version"),
        F.lit(baseline).alias("baseline_version"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.coalesce(F.lit(dataset_version).cast("string"), F.lit("unknown")).alias("dataset_version"),
        *[c for c in comp.columns],
        "n_regressions", "outcome",
    )


def metric_summary_rows(report: DataFrame, created_at=None) -> DataFrame:
    """metric_summary rows from a report; outcome_reason is JSON
    with NULLs kept; p50/p95 are the candidate's exact percentiles (T15)."""
    reason = F.to_json(
        F.struct(F.col("pct_change"), F.col("p_value"), F.col("is_regression")),
        {"ignoreNullFields": "false"},
    )
    sid = F.md5(F.concat_ws("|", F.col("candidate_version"), F.col("baseline_version"),
                            F.coalesce(F.col("run_id"), F.lit(""))))
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return report.select(
        sid.alias("summary_id"), "run_id",
        F.col("candidate_version").alias("model_version"), "dataset_version", "metric_name",
        F.col("candidate_mean").alias("metric_mean"), F.col("candidate_std").alias("metric_std"),
        F.col("candidate_p50").alias("metric_p50"), F.col("candidate_p95").alias("metric_p95"),
        F.col("n_candidate").alias("sample_size"), "outcome",
        reason.alias("outcome_reason"), "baseline_version", "baseline_mean", "p_value",
        ts.alias("created_at"),
    )


def alert_payload(report: DataFrame, labels=ALERT_LABELS) -> DataFrame:
    """For a outcome in ``labels``, the regressed metrics only."""
    return report.where(F.col("outcome").isin(list(labels)) & F.coalesce(F.col("is_regression"), F.lit(False))) \
        .select("outcome", "candidate_version", "baseline_version", "metric_name", "pct_change", "p_value")


def outcome_history_topn(summary: DataFrame, model_version: str | None = None, n: int = 100) -> DataFrame:
    """L1: newest summary rows, optionally for one model (top-k by time with
    a total tie-break, planned as TakeOrderedAndProject)."""
    df = summary if model_version is None else summary.where(F.col("model_version") == model_version)
    return df.orderBy(F.col("created_at").desc(), F.col("run_id"), F.col("metric_name")).limit(n)
