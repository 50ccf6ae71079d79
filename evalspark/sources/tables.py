"""Parquet table scans and the bindings that map the driver tables onto the
evaluation data model (prompts, responses, long metric scores, summaries,
chunks, QA pairs, run events).

Each binding is a lazy DataFrame over one or two scans; Catalyst prunes the
columns and pushes the filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn followed by the assistant turn (prompt/response/truth).

    Equi-join on (conv_id, turn + 1) rather than a window over conv_id, so a
    single very long conversation is spread over tasks instead of one.
    """
    conv = read_table(spark, sf_dir, "conversations")
    u = conv.where(F.col("role") == "user").select(
        F.col("conv_id").alias("u_conv"), F.col("turn").alias("u_turn"), F.col("text").alias("u_text"))
    a = conv.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("a_conv"), F.col("turn").alias("a_turn"), F.col("text").alias("a_text"))
    j = u.join(a, (F.col("a_conv") == F.col("u_conv")) & (F.col("a_turn") == F.col("u_turn") + 1))
    k = F.col("u_conv")
    truth = (
        F.when(k % 5 == 0, F.concat(F.lit("  "), F.translate("a_text", LOWER, UPPER), F.lit(" ")))
        .when(k % 5 == 1, F.substring("a_text", 1, 20))
        .otherwise(F.col("u_text"))
    )
    return j.select(
        F.concat(_s(k), F.lit("-"), _s(F.col("u_turn"))).alias("prompt_id"),
        F.concat(F.lit("v"), _s(k % 3 + 1)).alias("dataset_version"),
        _s(1 + k % 2).alias("model_version"),
        F.col("u_text").alias("prompt"),
        F.col("a_text").alias("response"),
        truth.alias("ground_truth"),
    )


def prompts(spark: SparkSession, sf_dir: str, pairs_df: DataFrame | None = None) -> DataFrame:
    """Versioned prompt rows in the prompt-dataset shape (from ``pairs_df``
    when given, e.g. an already materialized pairs table)."""
    src = pairs(spark, sf_dir) if pairs_df is None else pairs_df
    return src.select(
        "prompt_id", "dataset_version", "prompt", "ground_truth",
        F.lit("2024-01-01").cast("date").alias("created_at"),
        F.lit("2024-01-02").cast("date").alias("updated_at"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model response per event; ``value`` is the latency."""
    ev = read_table(spark, sf_dir, "events")
    failed = F.col("event_type").isin("error", "signup")
    return ev.select(
        _s(F.col("event_id")).alias("response_id"),
        _s(F.col("user_id")).alias("prompt_id"),
        _s(F.col("user_id") % 3).alias("model_version"),
        F.lit("endpoint-a").alias("endpoint_name"),
        F.when(~failed, F.col("props")).alias("response"),
        F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("latency_ms"),
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "signup", "http_429")
        .otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("message "), _s(F.col("user_id") % 4))).alias("error_message"),
        F.col("ts").cast("date").alias("created_at"),
        F.concat(F.lit("run-"), _s(F.col("user_id") % 3)).alias("run_id"),
    )


def evals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long metric scores: four metrics per lineitem row, one scan + unpivot.

    Baseline is version '1' (linestatus F), candidate '2' (linestatus O).
    """
    li = read_table(spark, sf_dir, "lineitem")
    is_o = F.col("l_linestatus") == "O"
    wide = li.select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("n"),
        F.when(F.col("l_linestatus") == "F", "1").otherwise("2").alias("model_version"),
        (F.col("l_discount") * 10 * F.when(is_o, 0.93).otherwise(1.0)).cast("double").alias("faithfulness"),
        ((1 + F.col("l_linenumber") % 5) * F.when(is_o, 0.85).otherwise(1.0)).cast("double").alias("judge_score"),
        (F.col("l_quantity") / 50).cast("double").alias("answer_relevance"),
        (F.col("l_extendedprice") / 100 * F.when(is_o, 1.08).otherwise(1.0)).cast("double").alias("latency_p95"),
    )
    long = wide.unpivot(
        ["k", "n", "model_version"],
        ["faithfulness", "judge_score", "answer_relevance", "latency_p95"],
        "metric_name", "metric_value",
    )
    return long.select(
        F.concat_ws("-", "metric_name", _s(F.col("k")), _s(F.col("n"))).alias("eval_id"),
        "metric_name", "model_version", "metric_value",
    )


def _metric_of(custkey: Column) -> Column:
    m = custkey % 5
    return (F.when(m == 0, "faithfulness").when(m == 1, "answer_relevance").when(m == 2, "judge_score")
            .when(m == 3, "rouge_l").otherwise("latency_p95"))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregated metric rows per model version and run (one run per year).

    The baseline means are the version-'1' rows of the same aggregate, read
    with a window over the aggregated rows, so orders is scanned and
    aggregated once.
    """
    o = read_table(spark, sf_dir, "orders")
    m = (
        o.select(
            F.substring("o_orderpriority", 1, 1).alias("model_version"),
            F.year("o_orderdate").alias("y"),
            _metric_of(F.col("o_custkey")).alias("metric_name"),
            "o_totalprice", "o_orderdate",
        )
        .groupBy("model_version", "y", "metric_name")
        .agg(
            F.avg("o_totalprice").alias("metric_mean"),
            F.stddev_pop("o_totalprice").alias("metric_std"),
            F.count(F.lit(1)).alias("sample_size"),
            F.max(F.col("o_orderdate").cast("date")).alias("created_at"),
        )
        .withColumn("run_id", F.concat(F.lit("run-"), _s(9999 - F.col("y"))))
    )
    # baseline = the version-'1' row of the same (year, metric) group: a window
    # over the aggregated rows (one per model version), no second aggregation
    base = F.max(F.when(F.col("model_version") == "1", F.col("metric_mean"))) \
        .over(Window.partitionBy("y", "metric_name"))
    j = m.withColumn("baseline_mean", base)
    vsel = (F.col("model_version").cast("int") + F.col("y")) % 3
    return j.select(
        "model_version", "run_id", "metric_name", "metric_mean", "metric_std", "sample_size", "created_at",
        F.lit("1").alias("baseline_version"), "baseline_mean",
        ((F.col("sample_size") % 100).cast("double") / 100).alias("p_value"),
        F.when(vsel == 0, "PASS").when(vsel == 1, "WARN").otherwise("FAIL").alias("outcome"),
        F.when(F.col("sample_size") % 2 == 0, '{"is_regression": true}')
        .when(F.col("sample_size") % 3 == 0, '{"is_regression": null}')
        .otherwise('{"is_regression": false}').alias("outcome_reason"),
    )


def _quoted(c: Column) -> Column:
    """The text inside a JSON string."""
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(raw), F.lit(written))
    return c


def said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation text, with quotes and braces around a part of it."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select(F.concat_ws("-", "conv_id", "turn").alias("reply_id"), (F.col("conv_id") + F.col("turn")).alias("k"),
                    F.concat(F.lit('He said "{'), F.substring("text", 1, 40), F.lit('}"\n\\ '), F.col("text")).alias("t"))


def judge_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten shapes of judge replies about the texts of conversations: JSON with
    text around it, string, missing, null and fractional scores, unescaped
    quotes, text after the object, two objects, no JSON at all, no reply."""
    q, t = _quoted(F.col("t")), F.col("t")
    score = _s(F.col("k") % 5 + 1)
    shapes = [
        F.concat(F.lit('Here: {"score": '), score, F.lit(', "reasoning": "'), q, F.lit('", "strengths": ["'), q, F.lit('", "b"], "weaknesses": []} done')),
        F.concat(F.lit('{"score": "3", "reasoning": "'), q, F.lit('"}')),
        F.concat(F.lit('{"reasoning": "'), q, F.lit('"}')),
        F.concat(F.lit('{"score": '), score, F.lit(', "reasoning": "'), t, F.lit('"}')),
        F.concat(F.lit("no score: "), t),
        F.concat(F.lit('{"score": null, "reasoning": "'), q, F.lit('"}')),
        F.concat(F.lit('{"score": 4.5, "reasoning": "'), q, F.lit('"} tail }')),
        F.concat(F.lit('{"score": 2, "reasoning": "'), q, F.lit('"} and {"score": 5}')),
        F.concat(F.lit('```json\n{"score": 4.5,\n "reasoning": "'), q, F.lit('",\n "weaknesses": ["x"]}\n```')),
        F.lit(None).cast("string"),
    ]
    out = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        out = F.when(F.col("k") % len(shapes) == i, shape).otherwise(out)
    return said(spark, sf_dir).select("reply_id", out.alias("result"))


def endpoint_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shapes of serving-endpoint bodies around the texts of conversations."""
    q, t = _quoted(F.col("t")), F.col("t")
    shapes = [
        F.concat(F.lit('{"predictions": ["'), q, F.lit('"]}')),
        F.concat(F.lit('{"predictions": [{"content": "'), q, F.lit('"}]}')),
        F.concat(F.lit('{"choices": [{"message": {"role": "assistant", "content": "'), q, F.lit('"}}]}')),
        F.concat(F.lit('{"choices": [{"text": "'), q, F.lit('"}]}')),
        F.concat(F.lit('{"other": "'), q, F.lit('"}')),
        F.concat(F.lit('{"predictions": ["'), t, F.lit('"]}')),
        F.concat(F.lit('{"predictions": ["'), q, F.lit('"]} trailing')),
        t,
    ]
    out = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        out = F.when(F.col("k") % len(shapes) == i, shape).otherwise(out)
    return said(spark, sf_dir).select("reply_id", out.alias("body"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document chunks long enough to generate questions from."""
    d = read_table(spark, sf_dir, "documents")
    return d.where(F.length(F.trim("text")) >= 50).select(
        _s(F.col("doc_id")).alias("chunk_id"),
        F.concat(F.lit("v"), _s(F.col("doc_id") % 3 + 1)).alias("dataset_version"),
        F.col("lang").alias("source_collection"),
        "source",
        F.trim("text").alias("source_text"),
        F.lit("2024-01-01").cast("date").alias("created_at"),
    )


def qa(spark: SparkSession, sf_dir: str, chunks_df: DataFrame | None = None) -> DataFrame:
    """Deterministic stand-in for generated QA pairs: every seventh chunk has
    none, even ids have two. Generated with explode (no join)."""
    c = chunks(spark, sf_dir) if chunks_df is None else chunks_df
    idn = F.col("chunk_id").cast("bigint")
    n = F.when(idn % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        c.where(idn % 7 != 0)
        .select("chunk_id", "dataset_version", "source_text", F.explode(n).alias("i"))
        .select(
            "chunk_id", "dataset_version",
            F.concat(F.lit("Q"), _s(F.col("i")), F.lit(": "), F.md5("source_text")).alias("question"),
            F.concat(F.lit("A"), _s(F.col("i")), F.lit(": "), F.md5(F.concat("source_text", F.lit("|"), _s(F.col("i")))))
            .alias("ground_truth"),
            "source_text",
        )
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-state updates: the latest by (ts, event_id) wins per (run, key)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        _s(F.col("user_id")).alias("run_id"),
        F.col("event_type").alias("k"),
        F.col("props").alias("v"),
        "ts", "event_id",
    )


def coverage_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Responses and long evals for the coverage view: documents as responses,
    labels (quality, toxic) as per-response metric rows."""
    d = read_table(spark, sf_dir, "documents").select(
        _s(F.col("doc_id")).alias("response_id"),
        F.col("lang").alias("model_version"),
        F.col("source").alias("run_id"),
    )
    lab = read_table(spark, sf_dir, "labels")
    ev = lab.select(
        _s(F.col("doc_id")).alias("response_id"),
        F.col("quality").cast("double").alias("quality"),
        F.col("toxic").cast("double").alias("toxic"),
    ).unpivot(["response_id"], ["quality", "toxic"], "metric_name", "metric_value")
    return d, ev


class Bindings:
    """The bindings of one query: a binding the query reads more than once
    is computed once and written to the shared folder (``materialize``), and
    bindings derived from it (prompts from pairs, QA from chunks) read that
    copy, so the base scans, joins and aggregations run a single time."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def _once(self, name: str, build) -> DataFrame:
        from evalspark.session import materialize

        if name not in self._cache:
            self._cache[name] = materialize(build())
        return self._cache[name]

    def pairs(self) -> DataFrame:
        return self._once("pairs", lambda: pairs(self.spark, self.sf_dir))

    def prompts(self) -> DataFrame:
        return prompts(self.spark, self.sf_dir, self.pairs())

    def responses(self) -> DataFrame:
        return self._once("responses", lambda: responses(self.spark, self.sf_dir))

    def summary(self) -> DataFrame:
        return self._once("summary", lambda: summary(self.spark, self.sf_dir))

    def chunks(self) -> DataFrame:
        return chunks(self.spark, self.sf_dir)  # a pruned scan: nothing to keep

    def qa(self) -> DataFrame:
        return qa(self.spark, self.sf_dir, self.chunks())
