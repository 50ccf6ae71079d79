"""Latency, status and error aggregates over model responses (A3, A4, A16,
A21, P11, F14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.operators.ranking import exact_percentiles

ERROR_TEXT_LIMIT = 500


def latency_stats(df: DataFrame, by=("model_version",), accuracy: int = 10000) -> DataFrame:
    """A3: approximate p50/p95 (sketch), mean, sample std and row count.

    ``percentile_approx`` merges fixed-size sketches, so a hot group costs no
    more memory than a small one.
    """
    lat = F.col("latency_ms")
    return df.groupBy(*by).agg(
        F.percentile_approx(lat, 0.5, accuracy).alias("latency_p50"),
        F.percentile_approx(lat, 0.95, accuracy).alias("latency_p95"),
        F.avg(lat).alias("latency_mean"),
        F.stddev(lat).alias("latency_std"),
        F.count(F.lit(1)).alias("sample_size"),
    )


def latency_trends(
    df: DataFrame,
    by=("model_version", "endpoint_name", "created_at"),
    buckets: int | None = None,
) -> DataFrame:
    """A4: exact interpolated p50/p95/p99, mean, sample std and count per
    (model, endpoint, day), NULL latencies excluded.

    Percentiles and moments come from one table of value counts
    (``exact_percentiles``) instead of one in-memory value map per group; the
    raw rows are read once.
    """
    keys = list(by)
    out = exact_percentiles(df, keys, "latency_ms", {"latency_p50": 0.5, "latency_p95": 0.95, "latency_p99": 0.99}, buckets=buckets)
    return out.select(*keys, "latency_p50", "latency_p95", "latency_p99", F.col("mean").alias("latency_mean"),
                      F.col("std").alias("latency_std"), F.col("count").alias("request_count"))


def success_rate(df: DataFrame, by=("run_id",)) -> DataFrame:
    """Successes / total per group (0 for an empty group)."""
    ok = F.col("status") == "success"
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(ok).alias("successful_requests"),
    )
    return out.withColumn(
        "success_rate",
        F.when(F.col("total_requests") > 0,
               F.col("successful_requests").cast("double") / F.col("total_requests")).otherwise(F.lit(0.0)),
    )


def error_analysis(df: DataFrame) -> DataFrame:
    """Error counts by (model, status, message).

    ``error_rate_pct`` is the dashboard's share among the model's errors
    (T11); ``request_error_rate_pct`` is the share among all of the model's requests.
    The per-model denominators (W1) are added up from the counts and joined
    back, one row per model: messages are free text, so a window over a hot
    model's groups would put them all in one task.
    """
    is_err = F.coalesce(F.col("status") != "success", F.lit(False))
    # counted by an aggregate, not by a filter: both uses below are then the same plan, and the rows are read once
    g = df.groupBy("model_version", "status", "error_message").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_err).alias("_bad"))
    totals = g.groupBy(F.col("model_version").alias("_mv")).agg(F.sum("n").alias("_all"), F.sum("_bad").alias("_err"))
    j = g.where(F.col("_bad") > 0).join(totals, F.col("model_version").eqNullSafe(F.col("_mv")))
    return j.select(
        "model_version", "status",
        F.col("n").alias("error_count"),
        (F.col("n").cast("double") * 100.0 / F.col("_err")).alias("error_rate_pct"),
        (F.col("n").cast("double") * 100.0 / F.col("_all")).alias("request_error_rate_pct"),
        "error_message",
    )


def classify_status(status_code: Column, error_text: Column, limit: int = ERROR_TEXT_LIMIT):
    """200 -> success; other code -> http_<code> with the body cut
    to ``limit`` characters; no code (raised call) -> error with its text."""
    status = F.when(status_code.isNull(), F.lit("error")) \
              .when(status_code == 200, F.lit("success")) \
              .otherwise(F.concat(F.lit("http_"), status_code.cast("string")))
    message = F.when(status_code.isNull(), error_text) \
               .when(status_code == 200, F.lit(None).cast("string")) \
               .otherwise(F.substring(error_text, 1, limit))
    return status, message
