"""Calls to model, judge and question-generation functions as partitioned
Spark jobs (K1, K2, K4, J10, L7, P18, U2).

The network client is supplied by the caller; each partition runs its calls
through a small thread pool (the calls are I/O bound) inside ``mapInPandas``.
Keys travel with every row, so no positional re-association is needed, and
ids are content hashes, so a re-executed task after executor loss produces
the same rows and the keyed upsert stays idempotent. The output of each call
stage is written in waves as it finishes (the functions are eager), many waves
to a Spark job, so later actions, key checks and recomputation after executor loss never call the
endpoint again, and a job that was stopped goes on where it stood.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.functions.judge import FAILED_PREFIX, extract_response_text, judge_prompt, parse_judgements
from evalspark.operators.datasets import content_id
from evalspark.operators.latency import classify_status
from evalspark.session import materialize, path_exists, recorded_path, ship_package

CALL_FIELDS = "status_code int, body string, error string, latency_ms double"


ROWS_PER_TASK = 500  # calls that a lost task repeats at most
ROWS_PER_WAVE = 200_000  # calls whose results are written together
TASKS_PER_JOB = 10_000  # tasks whose waves run as one Spark job


def _written_calls(src: DataFrame, key: str, fn: Callable, schema: str, partitions: int | None, results: str | None,
                   rows_per_wave: int = ROWS_PER_WAVE, max_waves: int | None = None) -> DataFrame:
    """The rows of ``src`` through ``fn``, written in waves as they finish.

    Rows whose ``key`` is in ``results`` already are not called again, so a
    job that failed or was stopped after some waves goes on where it stood: what
    a wave wrote stays, and a lost task repeats at most ROWS_PER_TASK calls.
    ``max_waves`` ends this call early (a budget). Returns all results so far.

    Every task holds rows of one wave and its file stays once it is committed,
    whatever becomes of the job, so a Spark job runs many waves in order, as
    many as there are free cores at a time; a run that breaks off repeats those
    that had not finished. With ``partitions`` there are never more
    tasks than that at work: one wave, one job.
    """
    spark = src.sparkSession
    path = recorded_path(spark, "calls") if results is None else results
    if results is not None and path_exists(spark, path):
        done = spark.read.schema(schema).parquet(path).select(key).distinct()
        src = src.join(done, key, "left_anti").select(*src.columns)
    todo = materialize(src)
    n = todo.count()
    waves = max(1, -(-n // rows_per_wave))
    asked = waves if max_waves is None else min(waves, max_waves)
    rows = max(1, n // waves)
    tasks = partitions or -(-rows // ROWS_PER_TASK)  # of a wave
    together = 1 if partitions else max(1, min(asked, TASKS_PER_JOB // tasks))  # waves of a job
    if not partitions:
        tasks = max(tasks, min(rows, -(-spark.sparkContext.defaultParallelism // together)))
    todo = todo.withColumn("_wave", F.pmod(F.xxhash64(F.lit("wave"), key), F.lit(waves)).cast("int"))
    if asked > together:  # a job reads its own waves only
        todo = materialize(todo.repartitionByRange("_wave").sortWithinPartitions("_wave"))
    for first in range(0, asked, together):
        end = min(asked, first + together)
        task = (F.col("_wave") - first) * tasks + F.pmod(F.xxhash64(F.lit("task"), key), F.lit(tasks)).cast("int")
        part = todo.where((F.col("_wave") >= first) & (F.col("_wave") < end)).repartitionById((end - first) * tasks, task)
        part.drop("_wave").mapInPandas(fn, schema).write.mode("append") \
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)  # a task's file is final at once
    return spark.read.schema(schema).parquet(path)


def _run_calls(texts: list, call: Callable, max_workers: int) -> pd.DataFrame:
    def one(t):
        start = time.perf_counter()
        try:
            code, body = call(t)
            err = None if code == 200 else (body if isinstance(body, str) else str(body))
            return int(code), (body if code == 200 else None), err, (time.perf_counter() - start) * 1000.0
        except Exception as e:  # noqa: BLE001 - a failed call becomes a row
            return None, None, str(e), (time.perf_counter() - start) * 1000.0

    with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
        res = list(pool.map(one, texts))
    return pd.DataFrame({
        "status_code": pd.array([r[0] for r in res], dtype="Int32"),
        "body": [r[1] for r in res],
        "error": [r[2] for r in res],
        "latency_ms": [r[3] for r in res],
    })


def call_per_row(df: DataFrame, text_col: str, call: Callable, carry: list[str], max_workers: int = 10,
                 partitions: int | None = None, **written) -> DataFrame:
    """Apply ``call(text) -> (status_code, body)`` to every row; the string
    columns in ``carry`` travel with the result (no join back), the first one is
    the key. ``written``: results, rows_per_wave, max_waves of ``_written_calls``."""
    ship_package(df.sparkSession)
    src = df.select(*[F.col(c).cast("string").alias(c) for c in carry], F.col(text_col).alias("_text"))
    schema = ", ".join(f"{c} string" for c in carry) + ", " + CALL_FIELDS

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = _run_calls(b["_text"].tolist(), call, max_workers)
            for c in reversed(carry):
                out.insert(0, c, b[c].to_numpy())
            yield out

    # external calls run once: later actions and lost executors read the written result
    return _written_calls(src, carry[0], fn, schema, partitions, written.pop("results", None), **written)


def batch_infer(
    prompts: DataFrame,
    call: Callable,
    model_version: str,
    run_id: str,
    endpoint_name: str,
    created_at=None,
    max_workers: int = 10,
    partitions: int | None = None,
    **written,
) -> DataFrame:
    """K1: one model_responses row per prompt. With ``results`` (a path) a
    later call goes on where an earlier one stood.

    ``call(prompt) -> (status_code, json_body)``; status and error text follow
    P11, the response text F9; constant columns are attached natively (P18).
    """
    keyed = prompts.withColumn("_key", content_id(F.lit(run_id), "prompt_id",
                                                  *(["dataset_version"] if "dataset_version" in prompts.columns
                                                    else [])))
    if "dataset_version" not in prompts.columns:
        keyed = keyed.withColumn("dataset_version", F.lit(None).cast("string"))
    j = call_per_row(keyed, "prompt", call, ["_key", "prompt_id", "dataset_version"], max_workers, partitions, **written)
    status, message = classify_status(F.col("status_code"), F.col("error"))
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return j.select(
        F.col("_key").alias("response_id"), "prompt_id",
        F.lit(model_version).alias("model_version"), F.lit(endpoint_name).alias("endpoint_name"),
        F.when(F.col("status_code") == 200, extract_response_text(F.col("body"))).alias("response"),
        "latency_ms", status.alias("status"), message.alias("error_message"),
        ts.alias("created_at"), F.lit(run_id).alias("run_id"), "dataset_version",
    )


def batch_judge(
    df: DataFrame,
    call: Callable,
    endpoint_name: str,
    run_id: str,
    created_at=None,
    max_workers: int = 10,
    partitions: int | None = None,
    id_col: str | None = None,
    **written,
) -> DataFrame:
    """K2: judge every (prompt, response, truth) row into eval_results rows.

    The judge prompt (F8) and the parse (F10) are native columns; only the
    call runs in Python. ``call(prompt) -> (status_code, json_body)``; the
    body's text is read without the ``.text`` fallback.
    """
    resp_id = F.col("response_id") if "response_id" in df.columns else F.lit(None).cast("string")
    version = F.col("dataset_version") if "dataset_version" in df.columns else F.lit(None).cast("string")
    # same key rule as the other eval rows: a response is judged under its own id
    own = F.coalesce(resp_id, F.col("prompt_id")) if id_col is None else F.col(id_col)
    keyed = df.select(
        content_id(F.lit(run_id), own, "model_version", F.lit("judge_score")).alias("_key"),
        resp_id.alias("response_id"), "prompt_id", "model_version", version.alias("dataset_version"),
        judge_prompt("prompt", "response", "ground_truth").alias("_jp"),
    )
    j = call_per_row(keyed, "_jp", call, ["_key", "response_id", "prompt_id", "model_version", "dataset_version"],
                     max_workers, partitions, **written)
    j = j.withColumn("_text", F.when(F.col("status_code") == 200,
                                     extract_response_text(F.col("body"), with_text=False)))
    j = parse_judgements(j, "_text", "_p")
    call_failed = F.col("status_code").isNull() | (F.col("status_code") != 200)
    fail_msg = F.coalesce(F.col("error"), F.concat(F.lit("HTTP "), F.col("status_code").cast("string")))
    score = F.when(call_failed, F.lit(None).cast("double")).otherwise(F.col("_p.score"))
    reasoning = F.when(call_failed, F.concat(F.lit(FAILED_PREFIX), fail_msg)).otherwise(F.col("_p.reasoning"))
    empty = F.array().cast("array<string>")
    details = F.to_json(F.struct(
        reasoning.alias("reasoning"),
        F.when(call_failed, empty).otherwise(F.col("_p.strengths")).alias("strengths"),
        F.when(call_failed, empty).otherwise(F.col("_p.weaknesses")).alias("weaknesses"),
    ))
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return j.select(
        F.col("_key").alias("eval_id"), "response_id", "prompt_id", "model_version",
        F.lit(run_id).alias("run_id"), F.lit("judge_score").alias("metric_name"),
        score.alias("metric_value"), details.alias("metric_details"),
        F.concat(F.lit("llm_judge:"), F.lit(endpoint_name)).alias("evaluator"),
        ts.alias("created_at"), "dataset_version",
        reasoning.alias("reasoning"),
    )


QA_SCHEMA = "_key string, chunk_id string, dataset_version string, question string, ground_truth string, source_text string, error string, attempts int"


def generate_qa(
    chunks: DataFrame,
    gen: Callable,
    pairs_per_chunk: int = 3,
    retries: int = 3,
    backoff_s: float = 1.0,
    min_chars: int = 50,
    partitions: int | None = None,
    id_col: str = "chunk_id",
    text_col: str = "source_text",
    max_workers: int = 10,
    **written,
) -> DataFrame:
    """K4: ``gen(text, chunk_id, n) -> [(question, answer), ...]`` per chunk,
    retried with exponential backoff (backoff_s * 2**attempt). A chunk that is
    too short or fails every attempt yields one row with ``error`` set and no
    question; generated pairs have ``error`` NULL.
    """
    ship_package(chunks.sparkSession)
    version = F.col("dataset_version") if "dataset_version" in chunks.columns else F.lit(None).cast("string")
    src = chunks.select(F.col(id_col).alias("chunk_id"), version.cast("string").alias("dataset_version"),
                        F.col(text_col).alias("source_text"))
    src = src.withColumn("_key", content_id("chunk_id", "dataset_version"))

    def one(key, cid, ver, text):
        if text is None or len(text) < min_chars:
            return [(key, cid, ver, None, None, text, f"chunk too short ({0 if text is None else len(text)} chars)", 0)]
        last = None
        for attempt in range(retries):
            try:
                pairs = gen(text, cid, pairs_per_chunk)
                return [(key, cid, ver, q, a, text, None, attempt + 1) for q, a in pairs]
            except Exception as e:  # noqa: BLE001
                last = e
                if backoff_s > 0:
                    time.sleep(backoff_s * (2 ** attempt))
        return [(key, cid, ver, None, None, text, f"failed after {retries} attempts: {last}", retries)]

    cols = ["_key", "chunk_id", "dataset_version", "question", "ground_truth", "source_text", "error", "attempts"]

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
                for made in pool.map(one, b["_key"], b["chunk_id"], b["dataset_version"], b["source_text"]):
                    rows.extend(made)
            out = pd.DataFrame(rows, columns=cols)
            out["attempts"] = out["attempts"].astype("int32")
            yield out

    # the generator runs once per chunk; everything downstream reads the written result
    return _written_calls(src, "_key", fn, QA_SCHEMA, partitions, written.pop("results", None), **written).drop("_key")


def judge_to_evals(responses: DataFrame, call: Callable, endpoint_name: str, run_id: str,
                   sample_size: int | None = None, created_at=None, max_workers: int = 10,
                   partitions: int | None = None) -> DataFrame:
    """K2 entry with the optional sample limit made repeatable (L2, T25):
    the first ``sample_size`` rows by md5 of the prompt id."""
    from evalspark.operators.datasets import deterministic_sample

    df = responses if sample_size is None else deterministic_sample(responses, sample_size, "prompt_id")
    return batch_judge(df, call, endpoint_name, run_id, created_at, max_workers, partitions)


def metrics_to_evals(df: DataFrame, metrics: list[str], score: Callable, run_id: str, created_at=None,
                     max_workers: int = 10, partitions: int | None = None, **written) -> DataFrame:
    """K3 with an external scorer: each requested metric that has a scorer
    (F22; others are skipped) is scored per evaluation record (F21) by
    ``score(scorer_name, question, output, expected_facts) -> float``; the
    values are written, not dropped (T5)."""
    from evalspark.operators.scoring import METRIC_TO_SCORER, SCORER_TAG, eval_records

    ship_package(df.sparkSession)
    wanted = [(m, METRIC_TO_SCORER[m]) for m in metrics if m in METRIC_TO_SCORER]
    if not wanted:
        return df.sparkSession.createDataFrame([], "eval_id string, response_id string, prompt_id string, "
                                                   "model_version string, run_id string, metric_name string, "
                                                   "metric_value double, metric_details string, evaluator string, "
                                                   "created_at timestamp, dataset_version string")
    none = F.lit(None).cast("string")
    # the identity of a response travels with its record, nothing is joined back
    rec = eval_records(df, carry={
        "prompt_id": F.col("prompt_id"), "model_version": F.col("model_version"),
        "response_id": F.col("response_id") if "response_id" in df.columns else none,
        "dataset_version": F.col("dataset_version") if "dataset_version" in df.columns else none,
    }).select("prompt_id", "model_version", "response_id", "dataset_version", F.col("inputs.question").alias("question"),
              "outputs", F.col("expectations.expected_facts").alias("facts"))
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric_name"), F.lit(s).alias("scorer"))
                                for m, s in wanted]))
    rows = rec.select("*", pairs.alias("_m")).select("*", "_m.metric_name", "_m.scorer").drop("_m")
    src = rows.select(content_id(F.lit(run_id), F.coalesce("response_id", "prompt_id"), "model_version",
                                 "metric_name").alias("eval_id"),
                      "response_id", "prompt_id", "model_version", "dataset_version", "metric_name", "scorer", "question",
                      "outputs", F.to_json("facts").alias("facts"))
    carry = ["eval_id", "response_id", "prompt_id", "model_version", "dataset_version", "metric_name"]
    schema = ", ".join(f"{c} string" for c in carry) + ", metric_value double, error string"

    def fn(batches):
        import json as _json

        def one(row):
            try:
                return float(score(row.scorer, row.question, row.outputs, _json.loads(row.facts))), None
            except Exception as e:  # noqa: BLE001
                return None, str(e)

        for b in batches:
            with ThreadPoolExecutor(max_workers=max(1, max_workers)) as pool:
                res = list(pool.map(one, b.itertuples(index=False)))
            out = b[carry].copy()
            out["metric_value"] = [r[0] for r in res]
            out["error"] = [r[1] for r in res]
            yield out

    scored = _written_calls(src, "eval_id", fn, schema, partitions, written.pop("results", None), **written)
    ts = F.current_timestamp() if created_at is None else F.lit(created_at).cast("timestamp")
    return scored.select(
        "eval_id", "response_id", "prompt_id", "model_version", F.lit(run_id).alias("run_id"), "metric_name",
        "metric_value", F.when(F.col("error").isNotNull(), F.to_json(F.struct(F.col("error").alias("error"))))
        .alias("metric_details"), F.lit(SCORER_TAG).alias("evaluator"), ts.alias("created_at"), "dataset_version")
