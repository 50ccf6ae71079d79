"""Incremental scoring over a file stream equals the batch evaluation."""

from pyspark.sql import functions as F

from evalspark.operators.scoring import evaluate
from evalspark.schemas import EVAL_RESULTS, MODEL_RESPONSES
from evalspark.session import scratch_path
from evalspark.sources import tables as T
from evalspark.streaming import incremental
from tests.conftest import SF001

METRICS = ["exact_match", "token_count"]


def test_stream_matches_batch_and_replays_are_idempotent(spark):
    n_fields = len(EVAL_RESULTS.fields)
    pairs = T.pairs(spark, SF001)
    resp = pairs.select(
        F.md5("prompt_id").alias("response_id"), "prompt_id", "model_version", F.lit("ep").alias("endpoint_name"),
        "response", F.lit(1.0).alias("latency_ms"), F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("timestamp").alias("created_at"),
        F.lit("r").alias("run_id"), "dataset_version")
    resp = spark.createDataFrame(resp.collect(), MODEL_RESPONSES)
    src = scratch_path(spark, "stream-src")
    resp.limit(10).write.parquet(src)
    resp.subtract(resp.limit(10)).write.mode("append").parquet(src)
    prompts = T.prompts(spark, SF001)
    sink = scratch_path(spark, "stream-evals")
    ckpt = scratch_path(spark, "stream-ckpt")
    q = incremental.score_stream(incremental.response_stream(spark, src, 1), prompts, sink, ckpt, "run-s", METRICS)
    q.awaitTermination(120)
    want = sorted((r.eval_id, r.metric_value) for r in evaluate(resp, prompts, "run-s", METRICS).collect())
    got = sorted((r.eval_id, r.metric_value) for r in incremental.read_scores(spark, sink).collect())
    assert got == want and len(got) == 2 * resp.count()
    # a fresh query over the same files (new checkpoint) rewrites its own batches only
    q2 = incremental.score_stream(incremental.response_stream(spark, src, 1), prompts, sink,
                                  scratch_path(spark, "stream-ckpt2"), "run-s", METRICS)
    q2.awaitTermination(120)
    again = sorted((r.eval_id, r.metric_value) for r in incremental.read_scores(spark, sink).collect())
    assert again == want
    assert len(EVAL_RESULTS.fields) == n_fields
