"""Registered queries: each name maps to a Spark plan over the driver tables
and, where SQL can express it, the equivalent DuckDB oracle text.

Every query reads whole tables through the bindings in
``evalspark.sources.tables``; parameters (versions, run ids, timestamps)
are fixed literals so results are reproducible.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.functions import judge as J
from evalspark.functions import text as X
from evalspark.operators import batch, datasets, latency, regression, runs, scoring, stats, testgen
from evalspark.plans import sqltext as Q
from evalspark.plans import views
from evalspark.plans.bindings_sql import with_bindings
from evalspark.session import scratch_path, ship_package
from evalspark.sources import store
from evalspark.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CANDIDATE, BASELINE = "2", "1"
FIXED_TS = "2024-06-01 00:00:00"
EVAL_RUN = "eval-run-1"
REG_RUN = "regression-run-1"
INFER_RUN = "infer-run-1"
JUDGE_RUN = "judge-run-1"
ENDPOINT = "endpoint-a"
JUDGE_ENDPOINT = "judge-endpoint"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- datasets

@query("dataset_versions", with_bindings("prompts") + """
SELECT dataset_version, count(*) AS prompt_count, min(created_at) AS created_at, max(updated_at) AS updated_at
FROM prompts GROUP BY dataset_version""")
def q_dataset_versions(spark, d):
    return datasets.dataset_versions(T.prompts(spark, d))


@query("latest_version", with_bindings("prompts") + """
SELECT dataset_version, created_at FROM (
  SELECT dataset_version, min(created_at) AS created_at FROM prompts GROUP BY dataset_version)
ORDER BY created_at DESC, dataset_version DESC LIMIT 1""")
def q_latest_version(spark, d):
    return datasets.latest_version(T.prompts(spark, d))


@query("load_dataset_version", with_bindings("prompts") + """
SELECT prompt_id, dataset_version, prompt, ground_truth, created_at, updated_at FROM prompts WHERE dataset_version = 'v2'""")
def q_load_dataset_version(spark, d):
    return datasets.load_version(T.prompts(spark, d), "v2", require_nonempty=True)


_UPSERT_PROMPTS_SRC = """
SELECT prompt_id, dataset_version, concat(prompt, ' [edited]') AS prompt, ground_truth, created_at, updated_at
FROM prompts WHERE dataset_version = 'v1'
UNION ALL
SELECT prompt_id, 'v4' AS dataset_version, prompt, ground_truth, created_at, updated_at FROM prompts WHERE dataset_version = 'v2'"""


@query("upsert_prompts", with_bindings("prompts", extra=[("src", _UPSERT_PROMPTS_SRC)]) + """
SELECT t.* FROM prompts t WHERE NOT EXISTS (
  SELECT 1 FROM src s WHERE s.prompt_id = t.prompt_id AND s.dataset_version = t.dataset_version)
UNION ALL SELECT * FROM src""")
def q_upsert_prompts(spark, d):
    p = T.Bindings(spark, d).prompts()
    src = p.where(F.col("dataset_version") == "v1").withColumn("prompt", F.concat("prompt", F.lit(" [edited]"))) \
        .unionByName(p.where(F.col("dataset_version") == "v2").withColumn("dataset_version", F.lit("v4")))
    return store.merge_plan(p, src, ["prompt_id", "dataset_version"])


_UPSERT_RESP_SRC = """
SELECT response_id, prompt_id, model_version, endpoint_name, 'retried' AS response, latency_ms, 'success' AS status,
       CAST(NULL AS VARCHAR) AS error_message, created_at, run_id
FROM responses WHERE status <> 'success'"""


@query("upsert_responses", with_bindings("responses", extra=[("src", _UPSERT_RESP_SRC)]) + """
SELECT t.* FROM responses t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.response_id = t.response_id)
UNION ALL SELECT * FROM src""")
def q_upsert_responses(spark, d):
    r = T.Bindings(spark, d).responses()
    src = r.where(F.col("status") != "success").withColumn("response", F.lit("retried")) \
        .withColumn("status", F.lit("success")).withColumn("error_message", F.lit(None).cast("string"))
    return store.merge_plan(r, src, ["response_id"])


@query("prompt_table_upsert", ORACLES["upsert_prompts"])
def q_prompt_table_upsert(spark, d):
    """S5/S8 end to end: create a keyed prompt table, load all prompts,
    upsert the changed subset, read the table back."""
    from evalspark.schemas import PROMPT_DATASETS

    p = T.Bindings(spark, d).prompts().select(
        "prompt_id", "dataset_version", "prompt", "ground_truth",
        F.create_map().cast("map<string,string>").alias("metadata"), "created_at", "updated_at")
    table = store.KeyedTable(spark, scratch_path(spark, "prompt-table"), PROMPT_DATASETS,
                                   ("prompt_id", "dataset_version"), "dataset_version")
    table.create()
    table.upsert(p)
    src = p.where(F.col("dataset_version") == "v1").withColumn("prompt", F.concat("prompt", F.lit(" [edited]"))) \
        .unionByName(p.where(F.col("dataset_version") == "v2").withColumn("dataset_version", F.lit("v4")))
    table.upsert(src)
    return table.read().select("prompt_id", "dataset_version", "prompt", "ground_truth",
                               F.col("created_at").cast("date").alias("created_at"),
                               F.col("updated_at").cast("date").alias("updated_at"))


@query("response_table_upsert", ORACLES["upsert_responses"])
def q_response_table_upsert(spark, d):
    """S5/S7 end to end on the response table."""
    from evalspark.schemas import MODEL_RESPONSES

    r = T.Bindings(spark, d).responses()
    table = store.KeyedTable(spark, scratch_path(spark, "response-table"), MODEL_RESPONSES,
                                   ("response_id",), "run_id")
    table.create()
    table.upsert(r)
    src = r.where(F.col("status") != "success").withColumn("response", F.lit("retried")) \
        .withColumn("status", F.lit("success")).withColumn("error_message", F.lit(None).cast("string"))
    table.upsert(src)
    return table.read().select(*[c for c in r.columns if c != "created_at"],
                               F.col("created_at").cast("date").alias("created_at")).select(*r.columns)


@query("file_source_roundtrip", with_bindings("pairs") + """
SELECT prompt, ground_truth, prompt_id FROM pairs""")
def q_file_source_roundtrip(spark, d):
    path = scratch_path(spark, "prompts-json")
    T.pairs(spark, d).select("prompt_id", F.col("prompt").alias("question"), F.col("ground_truth").alias("answer")) \
        .write.json(path)
    return datasets.read_prompts(spark, path, "json", prompt_col="question", truth_col="answer") \
        .select("prompt", "ground_truth", "prompt_id")


@query("file_formats", with_bindings("said") + """
SELECT f.fmt, reply_id AS prompt_id, t AS prompt, substr(t, 1, 30) AS ground_truth FROM said, (VALUES ('csv'), ('json'), ('parquet')) f(fmt)""")
def q_file_formats(spark, d):
    """Texts with quotes, braces and line breaks written in three formats, several files each, and read back."""
    rows = T.said(spark, d).select(F.col("reply_id").alias("prompt_id"), F.col("t").alias("question"), F.substring("t", 1, 30).alias("answer"))
    out = None
    for fmt in ("csv", "json", "parquet"):
        path = testgen.export(rows, scratch_path(spark, f"export-{fmt}"), fmt, rows_per_file=100)
        back = datasets.read_prompts(spark, path, fmt, "question", "answer").select(F.lit(fmt).alias("fmt"), "prompt_id", "prompt", "ground_truth")
        out = back if out is None else out.unionByName(back)
    return out


@query("rejected_records", with_bindings("said") + """
SELECT CASE WHEN k % 4 <> 0 THEN t END AS prompt, CASE WHEN k % 4 = 0 THEN concat('{"question": "', reply_id) END AS rejected FROM said""")
def q_rejected_records(spark, d):
    """Json lines of which every fourth breaks off; those are kept with their text."""
    said = T.said(spark, d)
    line = F.when(F.col("k") % 4 != 0, F.to_json(F.struct(F.col("t").alias("question")))).otherwise(F.concat(F.lit('{"question": "'), "reply_id"))
    path = scratch_path(spark, "rejected")
    said.select(line.alias("value")).write.text(path)
    return datasets.read_prompts(spark, path, "json", "question", None, schema="question string", rejected_col="rejected").select("prompt", "rejected")


@query("sample_responses", with_bindings("responses") + """
SELECT response_id, model_version, status FROM responses ORDER BY md5(response_id) LIMIT 100""")
def q_sample_responses(spark, d):
    return datasets.deterministic_sample(T.responses(spark, d), 100, "response_id") \
        .select("response_id", "model_version", "status")


_UPSERT_EVALS_SRC = """
SELECT eval_id, metric_name, model_version, metric_value * 2 AS metric_value, 'run-b' AS run_id FROM evals_1 WHERE substr(md5(eval_id), 1, 1) = '7'
UNION ALL
SELECT concat(eval_id, '-again'), metric_name, model_version, metric_value, 'run-b' FROM evals_1 WHERE substr(md5(eval_id), 1, 2) = '00'"""
_EVALS_1 = ("evals_1", "SELECT eval_id, metric_name, min(model_version) AS model_version, min(metric_value) AS metric_value, 'run-a' AS run_id "
            "FROM evals WHERE metric_name = 'judge_score' GROUP BY 1, 2 HAVING count(*) = 1")


@query("eval_table_upsert", with_bindings("evals", extra=[_EVALS_1, ("src", _UPSERT_EVALS_SRC)]) + """
SELECT * FROM evals_1 t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.eval_id = t.eval_id) UNION ALL SELECT * FROM src""")
def q_eval_table_upsert(spark, d):
    """S7 on the eval table: some keys come back under another run, some are new."""
    from evalspark.schemas import EVAL_RESULTS

    ev = T.evals(spark, d).where(F.col("metric_name") == "judge_score").groupBy("eval_id", "metric_name") \
        .agg(F.min("model_version").alias("model_version"), F.min("metric_value").alias("metric_value"), F.count(F.lit(1)).alias("n")) \
        .where("n = 1").drop("n") \
        .withColumn("run_id", F.lit("run-a"))
    table = store.KeyedTable(spark, scratch_path(spark, "eval-table"), EVAL_RESULTS, ("eval_id",), "run_id")
    table.upsert(ev)
    digest, moved = F.md5("eval_id"), F.lit("run-b")
    src = ev.where(F.substring(digest, 1, 1) == "7").withColumn("metric_value", F.col("metric_value") * 2) \
        .unionByName(ev.where(F.substring(digest, 1, 2) == "00").withColumn("eval_id", F.concat("eval_id", F.lit("-again"))))
    table.upsert(src.withColumn("run_id", moved))
    return table.read().select(*ev.columns)


_SUMMARY_ROWS = ("s0", """SELECT concat(model_version, '/', run_id) AS summary_id, run_id, model_version, 'v1' AS dataset_version, metric_name,
  metric_mean, metric_std, sample_size, outcome FROM summary""")


@query("summary_table_upsert", with_bindings("summary", extra=[_SUMMARY_ROWS]) + """
SELECT summary_id, CASE WHEN outcome = 'FAIL' THEN concat(run_id, '-again') ELSE run_id END AS run_id, model_version, dataset_version, metric_name,
  metric_mean, metric_std, sample_size, CASE WHEN outcome = 'FAIL' THEN 'WARN' ELSE outcome END AS outcome FROM s0""")
def q_summary_table_upsert(spark, d):
    """S8 on the summary table: failed comparisons are summarised again under another run."""
    from evalspark.schemas import METRIC_SUMMARY

    rows = T.Bindings(spark, d).summary().select(
        F.concat("model_version", F.lit("/"), "run_id").alias("summary_id"), "run_id", "model_version", F.lit("v1").alias("dataset_version"),
        "metric_name", "metric_mean", "metric_std", "sample_size", "outcome")
    table = store.KeyedTable(spark, scratch_path(spark, "summary-table"), METRIC_SUMMARY, ("summary_id", "metric_name"), "run_id")
    table.upsert(rows)
    table.upsert(rows.where("outcome = 'FAIL'").withColumn("outcome", F.lit("WARN")).withColumn("run_id", F.concat("run_id", F.lit("-again"))))
    return table.read().select(*rows.columns)


@query("chunk_table_upsert", with_bindings("chunks") + """
SELECT chunk_id, dataset_version, source_collection, source_text, cast(CASE WHEN source_collection = 'de' THEN 3 ELSE 1 END AS integer) AS qa_pairs_count
FROM chunks UNION ALL
SELECT chunk_id, concat(dataset_version, '-b'), source_collection, source_text, cast(3 AS integer) FROM chunks WHERE source_collection = 'fr'""")
def q_chunk_table_upsert(spark, d):
    """S8 on the chunk table: known chunks with new counts, the same chunk ids in a new version."""
    from evalspark.schemas import TESTGEN_CHUNKS

    rows = T.chunks(spark, d).select("chunk_id", "dataset_version", "source_collection", "source_text", F.lit(1).alias("qa_pairs_count"))
    table = store.KeyedTable(spark, scratch_path(spark, "chunk-table"), TESTGEN_CHUNKS, ("chunk_id", "dataset_version"), "dataset_version")
    table.upsert(rows)
    again = rows.withColumn("qa_pairs_count", F.lit(3))
    table.upsert(again.where("source_collection = 'de'").unionByName(
        again.where("source_collection = 'fr'").withColumn("dataset_version", F.concat("dataset_version", F.lit("-b")))))
    return table.read().select(*rows.columns)


# ---------------------------------------------------------------- text metrics

@query("text_metrics", with_bindings("pairs", "prompts") + f"""
SELECT r.prompt_id, r.dataset_version, r.model_version,
  {Q.exact_match('r.response', 'p.ground_truth')} AS exact_match,
  {Q.contains_match('r.response', 'p.ground_truth')} AS contains_match,
  {Q.response_length('r.response')} AS response_length,
  {Q.token_count('r.response')} AS token_count
FROM pairs r LEFT JOIN prompts p ON p.prompt_id = r.prompt_id AND p.dataset_version = r.dataset_version""")
def q_text_metrics(spark, d):
    b = T.Bindings(spark, d)
    resp = b.pairs().select("prompt_id", "dataset_version", "model_version", "response")
    j = scoring.join_prompts(resp, b.prompts())
    return X.text_metrics(j, rouge=False).select(
        "prompt_id", "dataset_version", "model_version", "exact_match", "contains_match", "response_length",
        "token_count")


@query("rouge_l", with_bindings("pairs", extra=Q.lcs_ctes("pairs", "prompt_id")) + f"""
SELECT k AS prompt_id, cast(lcs AS BIGINT) AS lcs, {Q.rouge_from('lcs', 'm', 'n')} AS rouge_l FROM lcs""")
def q_rouge_l(spark, d):
    p = T.pairs(spark, d)
    ship_package(spark)
    return p.select("prompt_id", X.lcs_length("response", "ground_truth").alias("lcs"), "response",
                    "ground_truth") \
        .select("prompt_id", "lcs", X.rouge_l_from_lcs("lcs", "response", "ground_truth").alias("rouge_l"))


_EVAL_METRICS = ["rouge_l", "exact_match", "contains_match", "response_length", "token_count"]


def _evaluated(spark, d, metrics=None, b=None):
    b = T.Bindings(spark, d) if b is None else b
    resp = b.pairs().select("prompt_id", "dataset_version", "model_version", "response")
    return scoring.evaluate(resp, b.prompts(), EVAL_RUN, metrics, created_at=FIXED_TS)


def _long_sql(metrics: list[str]) -> str:
    """CTE body: the long eval rows of the pairs (rouge via the lcs CTE)."""
    exprs = {
        "rouge_l": Q.rouge_from("l.lcs", "l.m", "l.n"),
        "exact_match": Q.exact_match("r.response", "p.ground_truth"),
        "contains_match": Q.contains_match("r.response", "p.ground_truth"),
        "response_length": Q.response_length("r.response"),
        "token_count": Q.token_count("r.response"),
    }
    parts = []
    for m in metrics:
        parts.append(
            f"SELECT CAST(NULL AS VARCHAR) AS response_id, r.prompt_id, r.model_version, '{m}' AS metric_name, "
            f"cast({exprs[m]} AS double) AS metric_value FROM pairs r "
            f"LEFT JOIN prompts p ON p.prompt_id = r.prompt_id AND p.dataset_version = r.dataset_version"
            + (" LEFT JOIN lcs l ON l.k = r.prompt_id" if m == "rouge_l" else ""))
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT md5(concat_ws('|', '{EVAL_RUN}', coalesce(response_id, prompt_id), model_version, metric_name)) "
            f"AS eval_id, response_id, prompt_id, model_version, '{EVAL_RUN}' AS run_id, metric_name, metric_value, "
            f"'deterministic' AS evaluator FROM ({body}) x")


def _long_bindings(metrics: list[str]) -> str:
    extra = (Q.lcs_ctes("pairs", "prompt_id") if "rouge_l" in metrics else []) + [("ev", _long_sql(metrics))]
    return with_bindings("pairs", "prompts", extra=extra)


@query("eval_long_table", _long_bindings(_EVAL_METRICS) + """
SELECT eval_id, prompt_id, model_version, run_id, metric_name, metric_value, evaluator FROM ev""")
def q_eval_long_table(spark, d):
    return _evaluated(spark, d).select("eval_id", "prompt_id", "model_version", "run_id", "metric_name",
                                       "metric_value", "evaluator")


_NO_ROUGE = ["exact_match", "contains_match", "response_length", "token_count"]


@query("run_metric_summary", _long_bindings(_NO_ROUGE) + f"""
SELECT metric_name, model_version, count(*) AS n, avg(metric_value) AS mean_value FROM ev
WHERE run_id = '{EVAL_RUN}' GROUP BY metric_name, model_version""")
def q_run_metric_summary(spark, d):
    return scoring.run_metric_summary(_evaluated(spark, d, _NO_ROUGE), EVAL_RUN)


@query("end_to_end_evaluation", _long_bindings(_EVAL_METRICS) + """
SELECT metric_name, model_version, count(*) AS n, avg(metric_value) AS mean_value FROM ev
GROUP BY metric_name, model_version""")
def q_end_to_end_evaluation(spark, d):
    return scoring.run_metric_summary(_evaluated(spark, d), None)


@query("prompt_scores", _long_bindings(_NO_ROUGE) + """
SELECT e.prompt_id, p.prompt, e.model_version, e.metric_name, e.metric_value, e.evaluator, r.response, p.ground_truth
FROM ev e JOIN pairs r ON e.prompt_id = r.prompt_id AND e.model_version = r.model_version
JOIN prompts p ON e.prompt_id = p.prompt_id""")
def q_prompt_scores(spark, d):
    b = T.Bindings(spark, d)
    return views.prompt_scores(_evaluated(spark, d, _NO_ROUGE, b), b.pairs(), b.prompts())


@query("eval_record_shape", with_bindings("pairs") + f"""
SELECT prompt AS question, coalesce(response, '') AS outputs,
  CASE WHEN {Q.nonempty('ground_truth')} THEN 1 ELSE 0 END AS n_expected,
  CASE WHEN {Q.nonempty('ground_truth')} THEN ground_truth END AS expected_fact,
  prompt_id FROM pairs""")
def q_eval_record_shape(spark, d):
    r = scoring.eval_records(T.pairs(spark, d))
    return r.select(
        F.col("inputs.question").alias("question"), "outputs",
        F.size("expectations.expected_facts").alias("n_expected"),
        F.element_at("expectations.expected_facts", 1).alias("expected_fact"),
        F.col("metadata.prompt_id").alias("prompt_id"),
    )


@query("metric_scorers", with_bindings("evals") + """
SELECT metric_name, scorer, count(*) AS n FROM (
  SELECT metric_name, CASE metric_name WHEN 'answer_relevance' THEN 'RelevanceToQuery'
    WHEN 'faithfulness' THEN 'RetrievalGroundedness' WHEN 'relevance' THEN 'RelevanceToQuery'
    WHEN 'correctness' THEN 'Correctness' WHEN 'safety' THEN 'Safety' END AS scorer FROM evals) x
WHERE scorer IS NOT NULL GROUP BY metric_name, scorer""")
def q_metric_scorers(spark, d):
    return scoring.mapped_metrics(T.evals(spark, d)).groupBy("metric_name", "scorer") \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- judge

@query("judge_parse", with_bindings("judge_texts") + f"""
SELECT reply_id, {Q.judge_parse_cols('result')} FROM judge_texts""")
def q_judge_parse(spark, d):
    t = J.parse_judgements(T.judge_texts(spark, d), "result", "p")
    return t.select("reply_id", "p.score", "p.reasoning", F.size("p.strengths").alias("n_strengths"),
                    F.size("p.weaknesses").alias("n_weaknesses"), "p.error", "p.parse_path")


@query("extract_response_text", with_bindings("endpoint_json") + f"""
SELECT reply_id, {Q.response_text('body')} AS text, {Q.response_text('body', False)} AS judge_text FROM endpoint_json""")
def q_extract_response_text(spark, d):
    e = J.extract_response_texts(T.endpoint_json(spark, d), "body", {"text": True, "judge_text": False})
    return e.select("reply_id", "text", "judge_text")


@query("judge_prompt", with_bindings("pairs") + f"""
SELECT prompt_id, {Q.judge_prompt('prompt', 'response', 'ground_truth')} AS judge_prompt FROM pairs""")
def q_judge_prompt(spark, d):
    return T.pairs(spark, d).select("prompt_id", J.judge_prompt("prompt", "response", "ground_truth")
                                    .alias("judge_prompt"))


def judge_call(prompt: str):
    """Deterministic stand-in judge endpoint (reply body as JSON text)."""
    if len(prompt) % 13 == 0:
        raise RuntimeError("judge timeout")
    reply = '{"score": %d, "reasoning": "length rule"}' % (len(prompt) % 5 + 1)
    return 200, json.dumps({"predictions": [reply]})


_JP = Q.judge_prompt("prompt", "response", "ground_truth")


@query("batch_judge", with_bindings("pairs") + f"""
SELECT md5(concat_ws('|', '{JUDGE_RUN}', prompt_id, model_version, 'judge_score')) AS eval_id, prompt_id, model_version,
  CASE WHEN length({_JP}) % 13 = 0 THEN NULL ELSE cast(length({_JP}) % 5 + 1 AS double) END AS metric_value,
  'llm_judge:{JUDGE_ENDPOINT}' AS evaluator,
  CASE WHEN length({_JP}) % 13 = 0 THEN 'Evaluation failed: judge timeout' ELSE 'length rule' END AS reasoning
FROM pairs""")
def q_batch_judge(spark, d):
    out = batch.batch_judge(T.pairs(spark, d), judge_call, JUDGE_ENDPOINT, JUDGE_RUN, created_at=FIXED_TS,
                            max_workers=4)
    return out.select("eval_id", "prompt_id", "model_version", "metric_value", "evaluator", "reasoning")


_JPP = Q.judge_prompt("p.prompt", "r.response", "p.ground_truth")


@query("evaluation_run", _long_bindings(_NO_ROUGE) + f"""
SELECT eval_id, prompt_id, model_version, metric_name, metric_value, evaluator FROM ev
UNION ALL
SELECT md5(concat_ws('|', '{EVAL_RUN}', r.prompt_id, r.model_version, 'judge_score')), r.prompt_id, r.model_version, 'judge_score',
  CASE WHEN length({_JPP}) % 13 = 0 THEN NULL ELSE cast(length({_JPP}) % 5 + 1 AS double) END, 'llm_judge:{JUDGE_ENDPOINT}'
FROM pairs r LEFT JOIN prompts p ON p.prompt_id = r.prompt_id AND p.dataset_version = r.dataset_version""")
def q_evaluation_run(spark, d):
    b = T.Bindings(spark, d)
    resp = b.pairs().select("prompt_id", "dataset_version", "model_version", "response")
    out = scoring.evaluate_run(resp, b.prompts(), EVAL_RUN, _NO_ROUGE, judge_call, JUDGE_ENDPOINT, FIXED_TS, max_workers=4)
    return out["evals"].select("eval_id", "prompt_id", "model_version", "metric_name", "metric_value", "evaluator")


def infer_call(prompt: str):
    """Deterministic stand-in model endpoint."""
    if len(prompt) % 11 == 0:
        raise RuntimeError("timeout")
    if len(prompt) % 7 == 0:
        return 503, "overloaded: %d characters" % len(prompt)
    return 200, json.dumps({"choices": [{"message": {"content": "Answer: " + prompt}}]})


@query("batch_inference", with_bindings("prompts") + f"""
SELECT md5(concat_ws('|', '{INFER_RUN}', prompt_id, dataset_version)) AS response_id, prompt_id,
  '{CANDIDATE}' AS model_version, '{ENDPOINT}' AS endpoint_name,
  CASE WHEN length(prompt) % 11 = 0 THEN NULL WHEN length(prompt) % 7 = 0 THEN NULL ELSE concat('Answer: ', prompt) END AS response,
  CASE WHEN length(prompt) % 11 = 0 THEN 'error' WHEN length(prompt) % 7 = 0 THEN 'http_503' ELSE 'success' END AS status,
  CASE WHEN length(prompt) % 11 = 0 THEN 'timeout' WHEN length(prompt) % 7 = 0 THEN concat('overloaded: ', cast(length(prompt) AS VARCHAR), ' characters') END AS error_message,
  '{INFER_RUN}' AS run_id
FROM prompts""")
def q_batch_inference(spark, d):
    out = batch.batch_infer(T.prompts(spark, d), infer_call, CANDIDATE, INFER_RUN, ENDPOINT, created_at=FIXED_TS,
                            max_workers=4)
    return out.select("response_id", "prompt_id", "model_version", "endpoint_name", "response", "status",
                      "error_message", "run_id")


@query("resumed_inference", ORACLES["batch_inference"])
def q_resumed_inference(spark, d):
    """K1: a run that ends after one wave of calls, then goes on: no prompt is called twice."""
    path, prompts = scratch_path(spark, "resumed-calls"), T.prompts(spark, d)
    out = None
    for waves in (1, None):
        out = batch.batch_infer(prompts, infer_call, CANDIDATE, INFER_RUN, ENDPOINT, created_at=FIXED_TS, max_workers=4,
                                results=path, rows_per_wave=100, max_waves=waves)
    return out.select("response_id", "prompt_id", "model_version", "endpoint_name", "response", "status", "error_message", "run_id")


# ---------------------------------------------------------------- responses

@query("latency_stats", with_bindings("responses") + """
SELECT model_version, quantile_disc(latency_ms, 0.5) AS latency_p50, quantile_disc(latency_ms, 0.95) AS latency_p95,
  avg(latency_ms) AS latency_mean, stddev_samp(latency_ms) AS latency_std, count(*) AS sample_size
FROM responses GROUP BY model_version""")
def q_latency_stats(spark, d):
    return latency.latency_stats(T.responses(spark, d))


@query("latency_trends", with_bindings("responses") + """
SELECT model_version, endpoint_name, created_at, quantile_cont(latency_ms, 0.5) AS latency_p50,
  quantile_cont(latency_ms, 0.95) AS latency_p95, quantile_cont(latency_ms, 0.99) AS latency_p99,
  avg(latency_ms) AS latency_mean, stddev_samp(latency_ms) AS latency_std, count(*) AS request_count
FROM responses WHERE latency_ms IS NOT NULL GROUP BY model_version, endpoint_name, created_at""")
def q_latency_trends(spark, d):
    return views.latency_trends(T.responses(spark, d))


@query("inference_success_rate", with_bindings("responses") + """
SELECT run_id, count(*) AS total_requests, cast(count_if(status = 'success') AS BIGINT) AS successful_requests,
  CASE WHEN count(*) > 0 THEN cast(count_if(status = 'success') AS double) / count(*) ELSE 0.0 END AS success_rate
FROM responses GROUP BY run_id""")
def q_inference_success_rate(spark, d):
    return latency.success_rate(T.responses(spark, d))


@query("status_classification", """
SELECT event_id,
  CASE WHEN code IS NULL THEN 'error' WHEN code = 200 THEN 'success' ELSE concat('http_', cast(code AS VARCHAR)) END AS status,
  CASE WHEN code IS NULL THEN err WHEN code = 200 THEN NULL ELSE substr(err, 1, 500) END AS error_message
FROM (SELECT event_id,
  CASE event_type WHEN 'signup' THEN 429 WHEN 'error' THEN NULL WHEN 'click' THEN 503 ELSE 200 END AS code,
  CASE WHEN event_type = 'error' THEN concat('connection reset ', props) ELSE repeat(props, 60) END AS err
FROM events) x""")
def q_status_classification(spark, d):
    ev = T.read_table(spark, d, "events")
    code = F.when(F.col("event_type") == "signup", 429).when(F.col("event_type") == "error", F.lit(None)) \
        .when(F.col("event_type") == "click", 503).otherwise(200).cast("int")
    err = F.when(F.col("event_type") == "error", F.concat(F.lit("connection reset "), F.col("props"))) \
        .otherwise(F.repeat(F.col("props"), 60))
    status, message = latency.classify_status(code, err)
    return ev.select("event_id", status.alias("status"), message.alias("error_message"))


@query("error_analysis", with_bindings("responses") + """
SELECT model_version, status, n AS error_count, cast(n AS double) * 100.0 / err AS error_rate_pct,
  cast(n AS double) * 100.0 / alln AS request_error_rate_pct, error_message FROM (
  SELECT model_version, status, error_message, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY model_version) AS alln,
    sum(CASE WHEN status <> 'success' THEN count(*) ELSE 0 END) OVER (PARTITION BY model_version) AS err
  FROM responses GROUP BY model_version, status, error_message) x
WHERE status <> 'success'""")
def q_error_analysis(spark, d):
    return views.error_analysis(T.responses(spark, d))


# ---------------------------------------------------------------- regression

_STATS_CTES = [
    ("base", f"""SELECT metric_name, metric_value AS v,
  CASE WHEN model_version = '{CANDIDATE}' THEN 1 ELSE 0 END AS is_c, CASE WHEN model_version = '{BASELINE}' THEN 1 ELSE 0 END AS is_b
  FROM evals WHERE model_version IN ('{CANDIDATE}', '{BASELINE}') AND metric_value IS NOT NULL
  AND metric_name IN ({", ".join(repr(m) for m in regression.DEFAULT_METRICS)})"""),
    ("g", "SELECT metric_name, v, sum(is_c) AS c, sum(is_b) AS b, sum(is_c) + sum(is_b) AS t FROM base GROUP BY 1, 2"),
    ("r", """SELECT *, coalesce(sum(t) OVER (PARTITION BY metric_name ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bt,
  coalesce(sum(c) OVER (PARTITION BY metric_name ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bc FROM g"""),
    ("sz", "SELECT metric_name, sum(c) AS n1, sum(b) AS n2, sum(c * v) / sum(c) AS m1, sum(b * v) / sum(b) AS m2 FROM g GROUP BY 1"),
    ("rs", """SELECT r.metric_name, any_value(sz.n1) AS n1, any_value(sz.n2) AS n2, any_value(sz.m1) AS candidate_mean,
  any_value(sz.m2) AS baseline_mean,
  sum(r.c * (r.bt + (r.t + 1) / 2.0)) AS r1, sum(cast(r.t AS double) * r.t * r.t - r.t) AS tie,
  sqrt(sum(r.c * (r.v - sz.m1) * (r.v - sz.m1)) / any_value(sz.n1)) AS candidate_std,
  sqrt(sum(r.b * (r.v - sz.m2) * (r.v - sz.m2)) / any_value(sz.n2)) AS baseline_std,
  max(CASE WHEN r.c > 0 AND r.bc <= floor(0.5 * (sz.n1 - 1)) AND floor(0.5 * (sz.n1 - 1)) < r.bc + r.c THEN r.v END) AS p50lo,
  max(CASE WHEN r.c > 0 AND r.bc <= ceil(0.5 * (sz.n1 - 1)) AND ceil(0.5 * (sz.n1 - 1)) < r.bc + r.c THEN r.v END) AS p50hi,
  max(CASE WHEN r.c > 0 AND r.bc <= floor(0.95 * (sz.n1 - 1)) AND floor(0.95 * (sz.n1 - 1)) < r.bc + r.c THEN r.v END) AS p95lo,
  max(CASE WHEN r.c > 0 AND r.bc <= ceil(0.95 * (sz.n1 - 1)) AND ceil(0.95 * (sz.n1 - 1)) < r.bc + r.c THEN r.v END) AS p95hi,
  max(cast(0.5 * (sz.n1 - 1) - floor(0.5 * (sz.n1 - 1)) AS double)) AS p50f, max(cast(0.95 * (sz.n1 - 1) - floor(0.95 * (sz.n1 - 1)) AS double)) AS p95f
  FROM r JOIN sz ON sz.metric_name = r.metric_name GROUP BY r.metric_name"""),
    ("mw0", """SELECT *, cast(n1 AS double) AS dn1, cast(n2 AS double) AS dn2, r1 - cast(n1 AS double) * (n1 + 1) / 2.0 AS u_statistic,
  sqrt(cast(n1 AS double) * n2 / 12.0 * ((cast(n1 AS double) + n2 + 1) - tie / ((cast(n1 AS double) + n2) * (cast(n1 AS double) + n2 - 1)))) AS sigma
  FROM rs"""),
    ("mw", f"""SELECT *, CASE WHEN n1 >= 2 AND n2 >= 2 AND sigma > 0 THEN
     (greatest(u_statistic, dn1 * dn2 - u_statistic) - dn1 * dn2 / 2.0 - 0.5) / sigma END AS z_score FROM mw0"""),
    ("mwp", f"""SELECT *, CASE WHEN n1 < 2 OR n2 < 2 THEN 1.0 WHEN z_score IS NULL THEN 1.0 ELSE {Q.p_value('z_score')} END AS p_value,
  CASE WHEN baseline_mean <> 0 THEN (candidate_mean - baseline_mean) / baseline_mean * 100.0 ELSE 0.0 END AS pct_change
  FROM mw"""),
    ("req", "SELECT * FROM (VALUES " + ", ".join(f"('{m}', {i})" for i, m in enumerate(regression.DEFAULT_METRICS))
     + ") t(metric_name, metric_order)"),
    ("cmp", f"""SELECT q.metric_name, q.metric_order,
  m.candidate_mean, m.baseline_mean, m.candidate_std, m.baseline_std,
  m.p50lo + (m.p50hi - m.p50lo) * m.p50f AS candidate_p50, m.p95lo + (m.p95hi - m.p95lo) * m.p95f AS candidate_p95,
  m.pct_change, m.u_statistic, m.z_score, m.p_value,
  CASE WHEN m.metric_name IS NULL THEN NULL WHEN contains(lower(m.metric_name), 'latency')
       THEN m.pct_change > {regression.THRESHOLD_PCT} AND m.p_value < {regression.P_VALUE_THRESHOLD}
       ELSE m.pct_change < -{regression.THRESHOLD_PCT} AND m.p_value < {regression.P_VALUE_THRESHOLD} END AS is_regression,
  cast(coalesce(m.n1, 0) AS BIGINT) AS n_candidate, cast(coalesce(m.n2, 0) AS BIGINT) AS n_baseline,
  CASE WHEN m.metric_name IS NULL THEN 'Insufficient data' END AS reason
  FROM req q LEFT JOIN mwp m ON m.metric_name = q.metric_name"""),
    ("rep", f"""SELECT *, count_if(coalesce(is_regression, false)) OVER () AS n_regressions,
  CASE WHEN count_if(coalesce(is_regression, false)) OVER () = 0 THEN 'PASS'
       WHEN count_if(coalesce(is_regression, false) AND abs(coalesce(pct_change, 0.0)) > {2 * regression.THRESHOLD_PCT}) OVER () > 0 THEN 'FAIL'
       ELSE 'WARN' END AS outcome FROM cmp"""),
]


def _reg_sql(select: str) -> str:
    return with_bindings("evals", extra=_STATS_CTES) + select


def _report(spark, d, buckets=None):
    return regression.regression_report(T.evals(spark, d), CANDIDATE, BASELINE, regression.DEFAULT_METRICS,
                                        run_id=REG_RUN, buckets=buckets)


@query("version_means", with_bindings("evals") + f"""
SELECT metric_name,
  avg(CASE WHEN model_version = '{CANDIDATE}' THEN metric_value END) AS candidate_mean,
  avg(CASE WHEN model_version = '{BASELINE}' THEN metric_value END) AS baseline_mean,
  stddev_pop(CASE WHEN model_version = '{CANDIDATE}' THEN metric_value END) AS candidate_std,
  stddev_pop(CASE WHEN model_version = '{BASELINE}' THEN metric_value END) AS baseline_std,
  count(CASE WHEN model_version = '{CANDIDATE}' THEN metric_value END) AS n_candidate,
  count(CASE WHEN model_version = '{BASELINE}' THEN metric_value END) AS n_baseline,
  CASE WHEN avg(CASE WHEN model_version = '{BASELINE}' THEN metric_value END) <> 0 THEN
    (avg(CASE WHEN model_version = '{CANDIDATE}' THEN metric_value END) - avg(CASE WHEN model_version = '{BASELINE}' THEN metric_value END))
    / avg(CASE WHEN model_version = '{BASELINE}' THEN metric_value END) * 100.0 ELSE 0.0 END AS pct_change
FROM evals WHERE model_version IN ('{CANDIDATE}', '{BASELINE}') AND metric_value IS NOT NULL GROUP BY metric_name""")
def q_version_means(spark, d):
    return stats.version_means(T.evals(spark, d), CANDIDATE, BASELINE)


@query("mann_whitney", _reg_sql("""
SELECT metric_name, cast(n1 AS BIGINT) AS n_candidate, cast(n2 AS BIGINT) AS n_baseline, u_statistic, z_score, p_value FROM mwp"""))
def q_mann_whitney(spark, d):
    return stats.mann_whitney(T.evals(spark, d), CANDIDATE, BASELINE, regression.DEFAULT_METRICS)


_BY_RUN = ("evals_run", f"""SELECT * FROM (SELECT *, CASE WHEN substr(md5(eval_id), 1, 1) < '8' THEN 'run-a' ELSE 'run-b' END AS run_id FROM evals) x
  WHERE (model_version = '{CANDIDATE}' AND run_id = 'run-a') OR (model_version = '{BASELINE}' AND run_id = 'run-b')""")


@query("mann_whitney_by_run", with_bindings("evals", extra=[_BY_RUN, ("base", _STATS_CTES[0][1].replace("FROM evals", "FROM evals_run")), *_STATS_CTES[1:]]) + """
SELECT metric_name, cast(n1 AS BIGINT) AS n_candidate, cast(n2 AS BIGINT) AS n_baseline, u_statistic, z_score, p_value FROM mwp""")
def q_mann_whitney_by_run(spark, d):
    """Each version in its own run."""
    run = F.when(F.substring(F.md5("eval_id"), 1, 1) < "8", "run-a").otherwise("run-b")
    return stats.mann_whitney(T.evals(spark, d).withColumn("run_id", run), CANDIDATE, BASELINE, regression.DEFAULT_METRICS, "run-a", "run-b")


@query("mann_whitney_exact", with_bindings("summary") + f"""
, s AS (SELECT metric_name, metric_mean AS v, model_version = '{CANDIDATE}' AS c,
          row_number() OVER (PARTITION BY metric_name ORDER BY metric_mean) AS r FROM summary
        WHERE model_version IN ('{CANDIDATE}', '{BASELINE}') AND metric_mean IS NOT NULL),
n AS (SELECT metric_name, count_if(c) AS n1, count_if(NOT c) AS n2, sum(r) FILTER (WHERE c) - count_if(c) * (count_if(c) + 1) // 2 AS u FROM s GROUP BY 1),
m AS (SELECT metric_name, n1, n2, u, mask FROM n, (SELECT unnest(range(0, 65536)) AS mask) x WHERE mask < (1 << (n1 + n2)) AND bit_count(mask) = n1),
a AS (SELECT metric_name, n1, n2, u, mask, sum(i + 1) - n1 * (n1 + 1) // 2 AS ui
      FROM m, (SELECT unnest(range(0, 16)) AS i) b WHERE (mask >> i) & 1 = 1 GROUP BY metric_name, n1, n2, u, mask)
SELECT metric_name, cast(n1 AS BIGINT) AS n_candidate, cast(n2 AS BIGINT) AS n_baseline, cast(u AS DOUBLE) AS u_statistic,
  least(1.0, 2.0 * count_if(ui >= greatest(u, n1 * n2 - u)) / count(*)) AS p_value
FROM a GROUP BY metric_name, n1, n2, u""".lstrip())
def q_mann_whitney_exact(spark, d):
    """A12's exact branch: the yearly means of each metric, at most eight a version; the oracle lists all arrangements."""
    rows = T.summary(spark, d).select("metric_name", "model_version", F.col("metric_mean").alias("metric_value"))
    return stats.mann_whitney(rows, CANDIDATE, BASELINE).drop("z_score")


_REPORT_COLS = ("metric_name, candidate_mean, baseline_mean, candidate_std, baseline_std, candidate_p50, candidate_p95, "
                "pct_change, u_statistic, z_score, p_value, is_regression, n_candidate, n_baseline, reason, outcome")


@query("regression_report", _reg_sql(f"SELECT {_REPORT_COLS} FROM rep"))
def q_regression_report(spark, d):
    return _report(spark, d).select(*[c.strip() for c in _REPORT_COLS.split(",")])


@query("overall_outcome", _reg_sql(f"""
SELECT cast(count_if(coalesce(is_regression, false)) AS BIGINT) AS n_regressions,
  cast(count_if(coalesce(is_regression, false) AND abs(coalesce(pct_change, 0.0)) > {2 * regression.THRESHOLD_PCT}) AS BIGINT) AS n_severe,
  count(*) AS n_metrics, any_value(outcome) AS outcome FROM rep"""))
def q_overall_outcome(spark, d):
    comp = regression.compare_metrics(T.evals(spark, d), CANDIDATE, BASELINE, regression.DEFAULT_METRICS)
    return regression.outcome_of(comp)


@query("metric_summary", _reg_sql(f"""
SELECT md5(concat_ws('|', '{CANDIDATE}', '{BASELINE}', '{REG_RUN}')) AS summary_id, '{REG_RUN}' AS run_id,
  '{CANDIDATE}' AS model_version, 'unknown' AS dataset_version, metric_name, candidate_mean AS metric_mean,
  candidate_std AS metric_std, candidate_p50 AS metric_p50, candidate_p95 AS metric_p95, n_candidate AS sample_size,
  outcome, '{BASELINE}' AS baseline_version, baseline_mean, p_value,
  CASE WHEN is_regression IS NULL THEN NULL WHEN is_regression THEN 'true' ELSE 'false' END AS reason_is_regression
FROM rep"""))
def q_metric_summary(spark, d):
    s = regression.metric_summary_rows(_report(spark, d), created_at=FIXED_TS)
    return s.select("summary_id", "run_id", "model_version", "dataset_version", "metric_name", "metric_mean",
                    "metric_std", "metric_p50", "metric_p95", "sample_size", "outcome", "baseline_version",
                    "baseline_mean", "p_value",
                    F.get_json_object("outcome_reason", "$.is_regression").alias("reason_is_regression"))


@query("alert_payload", _reg_sql(f"""
SELECT outcome, '{CANDIDATE}' AS candidate_version, '{BASELINE}' AS baseline_version, metric_name, pct_change, p_value
FROM rep WHERE outcome IN ('WARN', 'FAIL') AND coalesce(is_regression, false)"""))
def q_alert_payload(spark, d):
    return regression.alert_payload(_report(spark, d))


# ---------------------------------------------------------------- summary views

@query("outcome_history", with_bindings("summary") + """
SELECT model_version, run_id, outcome, created_at,
  count(*) FILTER (WHERE TRY_CAST(json_extract_string(outcome_reason, '$.is_regression') AS BOOLEAN) = true) AS regression_count,
  avg(p_value) AS avg_p_value
FROM summary GROUP BY model_version, run_id, outcome, created_at""")
def q_outcome_history(spark, d):
    return views.outcome_history(T.summary(spark, d))


@query("outcome_history_topn", with_bindings("summary") + f"""
SELECT model_version, run_id, metric_name, outcome, created_at FROM summary WHERE model_version = '{CANDIDATE}'
ORDER BY created_at DESC, run_id, metric_name LIMIT 20""")
def q_outcome_history_topn(spark, d):
    return regression.outcome_history_topn(T.summary(spark, d), CANDIDATE, 20) \
        .select("model_version", "run_id", "metric_name", "outcome", "created_at")


@query("metric_trends", with_bindings("summary") + """
SELECT model_version, metric_name, created_at, metric_mean, metric_std, sample_size FROM summary
WHERE metric_name IN ('faithfulness', 'answer_relevance', 'judge_score', 'rouge_l')""")
def q_metric_trends(spark, d):
    return views.metric_trends(T.summary(spark, d))


@query("regression_summary", with_bindings("summary") + """
SELECT model_version AS candidate_version, baseline_version, metric_name, metric_mean AS candidate_mean, baseline_mean,
  metric_mean - baseline_mean AS mean_diff,
  CASE WHEN baseline_mean > 0 THEN round((metric_mean - baseline_mean) / baseline_mean * 100.0, 2) ELSE 0.0 END AS pct_change,
  p_value, outcome, json_extract_string(outcome_reason, '$.is_regression') AS is_regression
FROM summary WHERE baseline_version IS NOT NULL""")
def q_regression_summary(spark, d):
    return views.regression_summary(T.summary(spark, d))


@query("version_comparison", with_bindings("summary") + f"""
SELECT coalesce(c.metric_name, b.metric_name) AS metric_name, c.metric_mean AS candidate_mean, c.metric_std AS candidate_std,
  b.metric_mean AS baseline_mean, b.metric_std AS baseline_std, c.metric_mean - b.metric_mean AS mean_diff,
  CASE WHEN b.metric_mean > 0 THEN round((c.metric_mean - b.metric_mean) / b.metric_mean * 100.0, 2) ELSE 0.0 END AS pct_change
FROM (SELECT metric_name, metric_mean, metric_std FROM (SELECT *, row_number() OVER (PARTITION BY metric_name
        ORDER BY created_at DESC, run_id DESC) AS rn FROM summary WHERE model_version = '{CANDIDATE}') x WHERE rn = 1) c
FULL OUTER JOIN (SELECT metric_name, metric_mean, metric_std FROM (SELECT *, row_number() OVER (PARTITION BY metric_name
        ORDER BY created_at DESC, run_id DESC) AS rn FROM summary WHERE model_version = '{BASELINE}') y WHERE rn = 1) b
ON c.metric_name = b.metric_name""")
def q_version_comparison(spark, d):
    return views.version_comparison(T.Bindings(spark, d).summary(), CANDIDATE, BASELINE)


@query("daily_summary", with_bindings("summary") + """
SELECT s.model_version, s.outcome, l.run_time AS latest_run_time,
  sum(CASE WHEN s.metric_name = 'faithfulness' THEN s.metric_mean END) AS faithfulness,
  sum(CASE WHEN s.metric_name = 'answer_relevance' THEN s.metric_mean END) AS answer_relevance,
  sum(CASE WHEN s.metric_name = 'judge_score' THEN s.metric_mean END) AS judge_score,
  sum(CASE WHEN s.metric_name = 'rouge_l' THEN s.metric_mean END) AS rouge_l,
  sum(CASE WHEN s.metric_name = 'latency_p95' THEN s.metric_mean END) AS latency_p95_ms
FROM summary s JOIN (
  SELECT model_version, run_id, run_time FROM (
    SELECT model_version, run_id, max(created_at) AS run_time,
      row_number() OVER (PARTITION BY model_version ORDER BY max(created_at) DESC, run_id DESC) AS rn
    FROM summary GROUP BY model_version, run_id) x WHERE rn = 1) l
ON s.model_version = l.model_version AND s.run_id = l.run_id
GROUP BY s.model_version, s.outcome, l.run_time""")
def q_daily_summary(spark, d):
    return views.daily_summary(T.Bindings(spark, d).summary())


@query("judge_distribution", with_bindings("evals") + """
SELECT model_version, metric_value AS judge_score, count(*) AS count,
  round(cast(count(*) AS double) * 100.0 / sum(count(*)) OVER (PARTITION BY model_version), 2) AS pct
FROM evals WHERE metric_name = 'judge_score' AND metric_value IS NOT NULL GROUP BY model_version, metric_value""")
def q_judge_distribution(spark, d):
    return views.judge_distribution(T.evals(spark, d))


@query("evaluation_coverage", with_bindings("cov_responses", "cov_evals") + """
SELECT mr.model_version, mr.run_id, count(DISTINCT mr.response_id) AS total_responses,
  count(DISTINCT er.response_id) AS evaluated_responses, count(DISTINCT er.metric_name) AS metrics_computed,
  round(cast(count(DISTINCT er.response_id) AS double) * 100.0 / count(DISTINCT mr.response_id), 2) AS coverage_pct
FROM cov_responses mr LEFT JOIN cov_evals er ON mr.response_id = er.response_id
GROUP BY mr.model_version, mr.run_id""")
def q_evaluation_coverage(spark, d):
    r, e = T.coverage_inputs(spark, d)
    return views.evaluation_coverage(r, e)


# ---------------------------------------------------------------- test generation

def _chunk_rows(spark, d):
    b = T.Bindings(spark, d)
    return testgen.chunk_rows(b.chunks(), b.qa())


_CHUNK_ROWS = ("chunk_rows", """SELECT c.chunk_id, c.dataset_version, c.source_collection, c.source_text,
  cast(coalesce(q.n, 0) AS integer) AS qa_pairs_count, c.created_at
  FROM chunks c LEFT JOIN (SELECT coalesce(chunk_id, 'unknown') AS chunk_id, count(*) AS n FROM qa GROUP BY 1) q
  ON q.chunk_id = c.chunk_id""")


@query("chunk_scan", with_bindings("chunks") + """
SELECT chunk_id AS id, source_text AS text, source_collection, source FROM chunks
WHERE length(trim(source_text)) >= 50 AND length(source_text) >= 50 AND source_collection = 'en'""")
def q_chunk_scan(spark, d):
    s = testgen.scan_chunks(T.chunks(spark, d), filter_field="source_collection", filter_value="en")
    return s.select("id", "text", F.col("metadata")["source_collection"].alias("source_collection"),
                    F.col("metadata")["source"].alias("source"))


@query("qa_counts", with_bindings("chunks", "qa", extra=[_CHUNK_ROWS]) + """
SELECT chunk_id, dataset_version, qa_pairs_count FROM chunk_rows""")
def q_qa_counts(spark, d):
    return _chunk_rows(spark, d).select("chunk_id", "dataset_version", "qa_pairs_count")


@query("chunk_versions", with_bindings("chunks", "qa", extra=[_CHUNK_ROWS]) + """
SELECT dataset_version, source_collection, count(*) AS chunk_count, cast(sum(qa_pairs_count) AS BIGINT) AS total_qa_pairs,
  min(created_at) AS first_created, max(created_at) AS last_created
FROM chunk_rows GROUP BY dataset_version, source_collection""")
def q_chunk_versions(spark, d):
    return testgen.chunk_versions(_chunk_rows(spark, d))


@query("generation_stats", with_bindings("chunks", "qa", extra=[_CHUNK_ROWS]) + """
SELECT count(*) AS total_chunks, cast(coalesce(sum(qa_pairs_count), 0) AS bigint) AS total_qa_pairs,
  coalesce(avg(qa_pairs_count), 0.0) AS avg_qa_per_chunk, cast(count_if(coalesce(qa_pairs_count, 0) = 0) AS BIGINT) AS skipped_chunks
FROM chunk_rows WHERE dataset_version = 'v1'""")
def q_generation_stats(spark, d):
    return testgen.generation_stats(_chunk_rows(spark, d), "v1")


@query("chunk_texts", with_bindings("chunks", "qa", extra=[_CHUNK_ROWS]) + """
SELECT chunk_id, source_text FROM chunk_rows WHERE dataset_version = 'v2'""")
def q_chunk_texts(spark, d):
    return testgen.chunk_texts(_chunk_rows(spark, d), "v2")


_NEG_K = 2

# The rule, within each dataset version: chunks in order of (document hash, document, chunk hash, chunk); a
# chunk takes k places from its own hash on among those outside its document,
# then the next ones of its document if there are not enough.
_NEG_CTES = [
    ("nb", """SELECT dataset_version AS ver, chunk_id AS id, coalesce(min(source), concat('chunk:', chunk_id)) AS doc,
  ('0x' || substr(md5(chunk_id), 1, 15))::BIGINT AS h FROM chunks GROUP BY dataset_version, chunk_id"""),
    ("npos", """SELECT *, row_number() OVER (PARTITION BY ver ORDER BY ('0x' || substr(md5(doc), 1, 15))::BIGINT, doc, h, id) - 1 AS pos,
  count(*) OVER (PARTITION BY ver) AS n, count(*) OVER (PARTITION BY ver, doc) AS s FROM nb"""),
    ("nblock", "SELECT *, min(pos) OVER (PARTITION BY ver, doc) AS o FROM npos"),
    ("nsrc", f"""SELECT b.*, j.j, n - s AS free FROM nblock b, (SELECT unnest(range(0, {_NEG_K})) AS j) j WHERE j.j < n - 1"""),
    ("ntarget", """SELECT ver, id, j, CASE WHEN j >= free THEN o + (pos - o + 1 + j - free) % s
  WHEN (h + j) % free < o THEN (h + j) % free ELSE (h + j) % free + s END AS target
  FROM nsrc"""),
    ("neg", """SELECT t.id AS chunk_id, cast(t.j + 1 AS integer) AS rank, c.id AS negative_chunk_id
  FROM ntarget t JOIN npos c ON c.pos = t.target AND c.ver = t.ver"""),
]


def _negatives(spark, d):
    return testgen.hard_negatives(T.chunks(spark, d), k=_NEG_K).drop("dataset_version")


@query("hard_negatives", with_bindings("chunks", extra=_NEG_CTES) + """
SELECT chunk_id, rank, negative_chunk_id FROM neg""")
def q_hard_negatives(spark, d):
    return _negatives(spark, d)


@query("retrieval_eval", with_bindings("chunks", "qa", extra=_NEG_CTES) + """
SELECT q.question AS query, q.chunk_id AS relevant_chunk_id, cast(coalesce(n.cnt, 0) AS INTEGER) AS n_negatives,
  coalesce(n.ids, '') AS hard_negative_chunk_ids
FROM qa q LEFT JOIN (SELECT chunk_id, count(*) AS cnt, string_agg(negative_chunk_id, ',' ORDER BY rank) AS ids
  FROM neg GROUP BY chunk_id) n ON n.chunk_id = q.chunk_id""")
def q_retrieval_eval(spark, d):
    b = T.Bindings(spark, d)
    r = testgen.retrieval_records(b.qa(), testgen.hard_negatives(b.chunks(), k=_NEG_K))
    return r.select("query", F.element_at("relevant_chunk_ids", 1).alias("relevant_chunk_id"),
                    F.size("hard_negative_chunk_ids").alias("n_negatives"),
                    F.array_join("hard_negative_chunk_ids", ",").alias("hard_negative_chunk_ids"))


@query("qa_export", with_bindings("chunks", "qa") + """
SELECT q.chunk_id, q.question, q.ground_truth, q.source_text, c.source_collection, c.source
FROM qa q LEFT JOIN chunks c ON c.chunk_id = q.chunk_id AND c.dataset_version = q.dataset_version""")
def q_qa_export(spark, d):
    b = T.Bindings(spark, d)
    r = testgen.qa_records(b.qa(), b.chunks())
    return r.select("chunk_id", "question", "ground_truth", "source_text",
                    F.col("metadata")["source_collection"].alias("source_collection"),
                    F.col("metadata")["source"].alias("source"))


@query("rag_eval_export", with_bindings("chunks", "qa") + """
SELECT question, source_text AS context, 1 AS n_contexts, ground_truth FROM qa""")
def q_rag_eval_export(spark, d):
    r = testgen.rag_records(T.qa(spark, d))
    return r.select("question", F.element_at("contexts", 1).alias("context"), F.size("contexts").alias("n_contexts"),
                    "ground_truth")


@query("qa_to_prompts", with_bindings("chunks", "qa") + """
SELECT md5(concat_ws('|', 'tg-v1', question, ground_truth, concat('[{"key":"chunk_id","value":"', chunk_id,
  '"},{"key":"source","value":"testgen"}]'))) AS prompt_id, 'tg-v1' AS dataset_version, question AS prompt, ground_truth,
  chunk_id, 'testgen' AS source FROM qa""")
def q_qa_to_prompts(spark, d):
    p = datasets.qa_to_prompts(T.qa(spark, d), "tg-v1", created_at=FIXED_TS)
    return p.select("prompt_id", "dataset_version", "prompt", "ground_truth",
                    F.col("metadata")["chunk_id"].alias("chunk_id"), F.col("metadata")["source"].alias("source"))


def digest_generator(text: str, chunk_id: str, n: int):
    """Deterministic stand-in generator: the QA binding's rule."""
    import hashlib

    k = int(chunk_id)
    if k % 7 == 0:
        return []
    count = 2 if k % 2 == 0 else 1
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    return [(f"Q{i}: {digest(text)}", f"A{i}: " + digest(f"{text}|{i}")) for i in range(1, min(n, count) + 1)]


@query("generate_qa", with_bindings("chunks", "qa") + """
SELECT chunk_id, question, ground_truth, source_text FROM qa""")
def q_generate_qa(spark, d):
    out = batch.generate_qa(T.chunks(spark, d), digest_generator, pairs_per_chunk=3, backoff_s=0.0)
    return out.where(F.col("error").isNull() & F.col("question").isNotNull()) \
        .select("chunk_id", "question", "ground_truth", "source_text")


@query("testgen_totals", with_bindings("chunks", "qa") + """
SELECT (SELECT count(*) FROM chunks) AS chunks, (SELECT count(*) FROM qa) AS qa_pairs, cast(0 AS BIGINT) AS skipped""")
def q_testgen_totals(spark, d):
    out = testgen.build_testset(T.Bindings(spark, d).chunks(), digest_generator, k=_NEG_K, backoff_s=0.0,
                                negatives=False)
    return out["totals"]


_LOAD_CHUNKS = ("loaded", """SELECT c.chunk_id, c.dataset_version, c.source_text, cast(count(q.question) AS integer) AS qa_pairs_count
  FROM chunks c LEFT JOIN qa q ON q.chunk_id = c.chunk_id AND q.dataset_version = c.dataset_version GROUP BY ALL""")


@query("testgen_load", with_bindings("chunks", "qa", extra=[_LOAD_CHUNKS]) + """
SELECT 'chunks' AS loaded, dataset_version, count(*) AS n, cast(sum(qa_pairs_count) AS BIGINT) AS qa_pairs,
  cast(count_if(qa_pairs_count = 0) AS BIGINT) AS skipped FROM loaded GROUP BY dataset_version
UNION ALL SELECT 'prompts', 'tg-v1', count(*), NULL, NULL FROM qa""")
def q_testgen_load(spark, d):
    """K7: QA pairs become prompts, their chunks get counts, both tables are loaded together and read back."""
    b = T.Bindings(spark, d)
    tables = store.create_catalog(spark, scratch_path(spark, "testgen-load"))
    prompts, chunks = tables["raw.prompt_datasets"], tables["metadata.testgen_chunks"]
    testgen.load_generated(prompts, chunks, b.chunks(), b.qa(), "tg-v1", FIXED_TS)
    by_version = chunks.read().groupBy(F.lit("chunks").alias("loaded"), "dataset_version").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qa_pairs_count").alias("qa_pairs"), F.count_if(F.col("qa_pairs_count") == 0).alias("skipped"))
    none = F.lit(None).cast("long")
    return by_version.unionByName(prompts.read().groupBy(F.lit("prompts").alias("loaded"), "dataset_version").agg(
        F.count(F.lit(1)).alias("n"), none.alias("qa_pairs"), none.alias("skipped")))


def length_scorer(scorer: str, question: str, output: str, facts: list) -> float:
    """Deterministic stand-in for an external scorer."""
    return float((len(output) + len(scorer)) % 5) + (0.5 if facts else 0.0)


@query("scorer_evals", with_bindings("pairs") + f"""
SELECT md5(concat_ws('|', '{EVAL_RUN}', prompt_id, model_version, metric_name)) AS eval_id, prompt_id, model_version,
  metric_name, cast((length(coalesce(response, '')) + length(scorer)) % 5 AS double)
    + CASE WHEN {Q.nonempty('ground_truth')} THEN 0.5 ELSE 0.0 END AS metric_value, 'mlflow_genai' AS evaluator
FROM pairs, (VALUES ('faithfulness', 'RetrievalGroundedness'), ('answer_relevance', 'RelevanceToQuery')) m(metric_name, scorer)""")
def q_scorer_evals(spark, d):
    out = batch.metrics_to_evals(T.pairs(spark, d), ["faithfulness", "answer_relevance", "judge_score"],
                                 length_scorer, EVAL_RUN, created_at=FIXED_TS, max_workers=4)
    return out.select("eval_id", "prompt_id", "model_version", "metric_name", "metric_value", "evaluator")


@query("judge_sample", with_bindings("pairs") + f"""
SELECT prompt_id, model_version,
  CASE WHEN length({_JP}) % 13 = 0 THEN NULL ELSE cast(length({_JP}) % 5 + 1 AS double) END AS metric_value
FROM pairs ORDER BY md5(prompt_id), prompt_id LIMIT 50""")
def q_judge_sample(spark, d):
    out = batch.judge_to_evals(T.pairs(spark, d), judge_call, JUDGE_ENDPOINT, JUDGE_RUN, sample_size=50,
                               created_at=FIXED_TS, max_workers=4)
    return out.select("prompt_id", "model_version", "metric_value")


# ---------------------------------------------------------------- runs

@query("run_state", with_bindings("run_events") + """
SELECT run_id, k, v, updated_at FROM (
  SELECT run_id, k, v, max(ts) OVER (PARTITION BY run_id, k) AS updated_at,
    row_number() OVER (PARTITION BY run_id, k ORDER BY ts DESC, event_id DESC) AS rn FROM run_events) x WHERE rn = 1""")
def q_run_state(spark, d):
    return runs.run_state(T.run_events(spark, d))


@query("run_state_values", with_bindings("run_events") + """
SELECT run_id, k, json_extract_string(v, '$.k') AS k_value, coalesce(json_extract_string(v, '$.missing'), 'pending') AS missing_value
FROM (SELECT run_id, k, v, row_number() OVER (PARTITION BY run_id, k ORDER BY ts DESC, event_id DESC) AS rn
      FROM run_events) x WHERE rn = 1""")
def q_run_state_values(spark, d):
    st = runs.run_state(T.run_events(spark, d))
    return st.select("run_id", "k", runs.json_get("v", "k").alias("k_value"),
                     runs.json_get("v", "missing", "pending").alias("missing_value"))


_RUN_KEYS = ("status", "config", "task:inference", "task:evaluation", "output:scores", "output:report", "job_id")
_LIFECYCLE = ("lifecycle", """SELECT cast(user_id AS VARCHAR) AS run_id, k, ts, event_id,
  CASE k WHEN 'status' THEN CASE WHEN event_id % 3 = 0 THEN 'completed' WHEN event_id % 3 = 1 THEN 'running' ELSE 'failed' END
    WHEN 'config' THEN props WHEN 'job_id' THEN concat('job-', event_id) WHEN 'output:scores' THEN props WHEN 'output:report' THEN concat('a "report" of ', event_id)
    ELSE CASE WHEN event_id % 2 = 0 THEN 'completed' ELSE 'running' END END AS v
  FROM (SELECT *, (""" + "[" + ", ".join(f"'{k}'" for k in _RUN_KEYS) + f"])[event_id % {len(_RUN_KEYS)} + 1] AS k FROM events) e")


def _json_sql(prefix: str) -> str:
    return (f"coalesce('{{' || string_agg(to_json(substr(k, {len(prefix) + 1})) || ':' || to_json(v), ',' ORDER BY k) "
            f"FILTER (WHERE starts_with(k, '{prefix}')) || '}}', '{{}}')")


@query("run_records", with_bindings(extra=[_LIFECYCLE]) + f"""
SELECT run_id, max(v) FILTER (WHERE k = 'job_id') AS job_id, max(v) FILTER (WHERE k = 'status') AS status, max(v) FILTER (WHERE k = 'config') AS config,
  {_json_sql('task:')} AS task_state, {_json_sql('output:')} AS outputs, min(first_ts) AS created_at, max(ts) AS updated_at,
  max(ts) FILTER (WHERE k = 'status' AND v IN ('completed', 'failed')) AS completed_at
FROM (SELECT *, min(ts) OVER (PARTITION BY run_id, k) AS first_ts, row_number() OVER (PARTITION BY run_id, k ORDER BY ts DESC, event_id DESC) AS rn
      FROM lifecycle) x WHERE rn = 1 GROUP BY run_id""")
def q_run_records(spark, d):
    """Events arrive in three batches, late ones among them, with a snapshot after each of the first two."""
    ev = T.read_table(spark, d, "events")
    i = F.col("event_id")
    k = F.element_at(F.array(*[F.lit(x) for x in _RUN_KEYS]), (i % len(_RUN_KEYS) + 1).cast("int"))
    rows = ev.select(F.col("user_id").cast("string").alias("run_id"), k.alias("k"), "props", "ts", "event_id").withColumn(
        "v", F.when(F.col("k") == "status", F.when(i % 3 == 0, "completed").when(i % 3 == 1, "running").otherwise("failed"))
        .when(F.col("k").isin("config", "output:scores"), F.col("props")).when(F.col("k") == "job_id", F.concat(F.lit("job-"), i))
        .when(F.col("k") == "output:report", F.concat(F.lit('a "report" of '), i))
        .otherwise(F.when(i % 2 == 0, "completed").otherwise("running")))
    log = runs.RunLog(spark, scratch_path(spark, "run-log"))
    for batch_no in range(3):
        log.append(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == batch_no))
        if batch_no < 2:
            log.snapshot()
    return log.records().drop("job_run_id")


@query("json_values", with_bindings(extra=[_LIFECYCLE]) + """
SELECT event_id, json_keys(props) AS keys, json_extract_string(props, '$.k') AS k_value,
  concat('{"k":', to_json(json_extract_string(props, '$.k')), ',"by":', to_json(event_type), '}') AS changed FROM events""")
def q_json_values(spark, d):
    """all keys, one value, and the object with one value set."""
    ev = T.read_table(spark, d, "events")
    return ev.select("event_id", F.json_object_keys("props").alias("keys"), runs.json_get("props", "k").alias("k_value"),
                     runs.json_set("props", "by", F.col("event_type")).alias("changed"))


# ---------------------------------------------------------------- ordered reads of views

def _registered(spark, name: str, view: DataFrame) -> DataFrame:
    """The view registered under its name and read by it."""
    prefix = f"read_{uuid.uuid4().hex[:8]}_"
    view.createOrReplaceTempView(prefix + name)
    return views.read_view(spark, name, prefix)


@query("ordered_outcome_history", with_bindings("summary") + """
SELECT *, row_number() OVER (ORDER BY created_at DESC, model_version, run_id, outcome) AS position FROM (
SELECT model_version, run_id, outcome, created_at,
  count(*) FILTER (WHERE TRY_CAST(json_extract_string(outcome_reason, '$.is_regression') AS BOOLEAN) = true) AS regression_count,
  avg(p_value) AS avg_p_value
FROM summary GROUP BY model_version, run_id, outcome, created_at)""")
def q_ordered_outcome_history(spark, d):
    return _registered(spark, "outcome_history", views.outcome_history(T.summary(spark, d)))


_EXACT_METRICS = ["exact_match", "contains_match", "response_length", "token_count"]


@query("ordered_prompt_scores", _long_bindings(_EXACT_METRICS) + """
SELECT *, row_number() OVER (ORDER BY metric_value, prompt_id, model_version, metric_name) AS position FROM (
SELECT e.prompt_id, p.prompt, e.model_version, e.metric_name, e.metric_value, e.evaluator, r.response, p.ground_truth
FROM ev e JOIN pairs r ON e.prompt_id = r.prompt_id AND e.model_version = r.model_version
JOIN prompts p ON e.prompt_id = p.prompt_id)""")
def q_ordered_prompt_scores(spark, d):
    b = T.Bindings(spark, d)
    return _registered(spark, "prompt_scores", views.prompt_scores(_evaluated(spark, d, _EXACT_METRICS, b), b.pairs(), b.prompts()))


@query("ordered_error_analysis", with_bindings("responses") + """
SELECT *, row_number() OVER (ORDER BY error_count DESC, model_version, status, error_message) AS position FROM (
SELECT model_version, status, n AS error_count, cast(n AS double) * 100.0 / err AS error_rate_pct,
  cast(n AS double) * 100.0 / alln AS request_error_rate_pct, error_message FROM (
  SELECT model_version, status, error_message, count(*) AS n,
    sum(count(*)) OVER (PARTITION BY model_version) AS alln,
    sum(CASE WHEN status <> 'success' THEN count(*) ELSE 0 END) OVER (PARTITION BY model_version) AS err
  FROM responses GROUP BY model_version, status, error_message) x
WHERE status <> 'success')""")
def q_ordered_error_analysis(spark, d):
    return _registered(spark, "error_analysis", views.error_analysis(T.responses(spark, d)))


@query("late_rows_in_view", with_bindings("responses") + """
SELECT model_version, quantile_cont(latency_ms, 0.5) AS latency_p50, count(*) AS request_count
FROM responses WHERE latency_ms IS NOT NULL GROUP BY model_version""")
def q_late_rows_in_view(spark, d):
    """A view registered over half of the rows shows the other half after it arrives."""
    path, rows = scratch_path(spark, "late-rows"), T.responses(spark, d)
    half = F.pmod(F.xxhash64("response_id"), F.lit(2))
    rows.where(half == 0).write.parquet(path)
    name = f"latency_{uuid.uuid4().hex[:8]}"
    latency.latency_trends(spark.read.parquet(path), by=("model_version",)).createOrReplaceTempView(name)
    rows.where(half == 1).write.mode("append").parquet(path)
    spark.catalog.refreshTable(name)
    return spark.table(name).select("model_version", "latency_p50", "request_count")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
