"""Hard negatives against brute force, exports, batch jobs with failures."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from evalspark.operators import batch, testgen
from evalspark.plans import views
from evalspark.session import scratch_path
from evalspark.sources import tables as T
from tests.conftest import SF001


def brute_negatives(chunks, k):
    """The stated rule: k places from the chunk's hash on among those outside its
    document, then the next chunks of its document."""
    h = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    named = [(c, d if d is not None else f"chunk:{c}") for c, d in chunks]
    order = sorted(named, key=lambda c: (h(c[1]), c[1], h(c[0]), c[0]))
    out = {}
    for p, (cid, doc) in enumerate(order):
        outside = [c for c, d in order if d != doc]
        block = [c for c, d in order if d == doc]
        at = block.index(cid)
        picks = [outside[(h(cid) + j) % len(outside)] for j in range(min(k, len(outside)))]
        picks += [block[(at + 1 + j) % len(block)] for j in range(min(k - len(picks), len(block) - 1))]
        out[cid] = picks
    return out


def listed(got):
    by = {}
    for r in got.collect():
        by.setdefault(r.chunk_id, []).append((r.rank, r.negative_chunk_id))
    return {k: [x for _, x in sorted(v)] for k, v in by.items()}


@pytest.mark.parametrize("n,docs,buckets,k", [(40, 3, 1, 2), (57, 1, 4, 2), (5, 2, 4, 4), (300, 10, 8, 3), (2, 2, 1, 2)])
def test_hard_negatives_brute_force(spark, n, docs, buckets, k):
    rows = [(f"c{i}", f"d{i % docs}" if i != 3 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "chunk_id string, source string")
    got = listed(testgen.hard_negatives(df, k=k, buckets=buckets))
    assert got == {c: x for c, x in brute_negatives(rows, k).items() if x}
    for cid, negs in got.items():
        assert cid not in negs and len(set(negs)) == len(negs)


def test_hard_negatives_skewed_document(spark):
    """One document holds 95 of 100 chunks: no negative of one's own document while others have chunks."""
    rows = [(f"c{i}", "big" if i < 95 else f"small{i}") for i in range(100)]
    doc = dict(rows)
    got = listed(testgen.hard_negatives(spark.createDataFrame(rows, "chunk_id string, source string"), k=2))
    assert len(got) == 100 and all(len(x) == 2 and all(doc[y] != doc[c] for y in x) for c, x in got.items())
    assert testgen.hard_negatives(spark.createDataFrame(rows[:1], "chunk_id string, source string")).count() == 0
    assert testgen.hard_negatives(spark.createDataFrame([], "chunk_id string, source string")).count() == 0


def test_versions_stay_apart(spark):
    """A pair of v1 counts for the chunk's v1 row only."""
    chunks = spark.createDataFrame([("c", "v1", "s", "col", "text one"), ("c", "v2", "s", "col", "text two")],
                                   "chunk_id string, dataset_version string, source string, source_collection string, source_text string")
    qa = spark.createDataFrame([("c", "v1", "q", "a", "text one")],
                               "chunk_id string, dataset_version string, question string, ground_truth string, source_text string")
    rows = testgen.chunk_rows(chunks, qa).collect()
    assert {r.dataset_version: r.qa_pairs_count for r in rows} == {"v1": 1, "v2": 0}
    assert [r.metadata["dataset_version"] for r in testgen.qa_records(qa, chunks).collect()] == ["v1"]
    assert [r.metadata["dataset_version"] for r in testgen.qa_records(qa.drop("dataset_version"), chunks).collect()] == ["v2"]


def test_scan_without_a_limit_returns_all(spark):
    df = spark.createDataFrame([(f"c{i}", "x" * 60) for i in range(350)], "chunk_id string, source_text string")
    assert testgen.scan_chunks(df).count() == 350 and testgen.scan_chunks(df, limit=10).count() == 10


def test_scores_stay_with_their_response(spark):
    """Two responses of one prompt, in two dataset versions: one score each, nothing multiplied."""
    df = spark.createDataFrame([("r1", "p", "1", "v1", "q", "abc", "t"), ("r2", "p", "1", "v2", "q", "de", "t")],
                               "response_id string, prompt_id string, model_version string, dataset_version string, "
                               "prompt string, response string, ground_truth string")
    out = batch.metrics_to_evals(df, ["faithfulness"], lambda s, q, o, f: float(len(o)), "run").collect()
    assert sorted((r.response_id, r.dataset_version, r.metric_value) for r in out) == [("r1", "v1", 3.0), ("r2", "v2", 2.0)]
    judged = batch.batch_judge(df, lambda p: (200, '{"predictions": ["{\\"score\\": 3, \\"reasoning\\": \\"r\\"}"]}'), "e", "run").collect()
    assert len({r.eval_id for r in judged}) == 2
    prompts = spark.createDataFrame([("p", "v1", "one", "t1"), ("p", "v2", "two", "t2")],
                                    "prompt_id string, dataset_version string, prompt string, ground_truth string")
    from evalspark.operators.scoring import evaluate, join_prompts

    joined = join_prompts(df, prompts).collect()
    assert sorted((r.response_id, r.prompt) for r in joined) == [("r1", "one"), ("r2", "two")]
    bare = join_prompts(df.drop("dataset_version"), prompts).collect()
    assert sorted((r.response_id, r.prompt) for r in bare) == [("r1", "two"), ("r2", "two")]
    evals = evaluate(df, prompts, "run", ["exact_match"])
    assert evals.select("eval_id").distinct().count() == evals.count() == 2
    shown = views.prompt_scores(evals, df, prompts).collect()
    assert sorted((r.prompt, r.response) for r in shown) == [("one", "abc"), ("two", "de")]


def test_exports_roundtrip(spark):
    qa = T.qa(spark, SF001)
    neg = testgen.hard_negatives(T.chunks(spark, SF001))
    ret = testgen.retrieval_records(qa, neg)
    assert ret.count() == qa.count()
    assert ret.where(F.size("hard_negative_chunk_ids") != 2).count() == 0
    path = scratch_path(spark, "retrieval")
    testgen.export(ret, path, "json")
    back = spark.read.json(path)
    assert back.count() == qa.count()
    rag = testgen.rag_records(qa)
    p2 = scratch_path(spark, "rag")
    testgen.export(rag, p2, "parquet")
    assert spark.read.parquet(p2).count() == qa.count()
    rec = testgen.qa_records(qa, T.chunks(spark, SF001))
    assert rec.where(F.size("metadata") == 0).count() == 0


def test_scan_chunks_filter_and_limit(spark):
    c = T.chunks(spark, SF001)
    s = testgen.scan_chunks(c, filter_field="source_collection", filter_value="en", limit=10)
    rows = s.collect()
    assert len(rows) == 10 and all(r.metadata["source_collection"] == "en" for r in rows)
    assert [r.id for r in rows] == sorted(r.id for r in rows)


def test_generation_stats_defaults(spark):
    c = T.chunks(spark, SF001)
    rows = testgen.chunk_rows(c, T.qa(spark, SF001))
    st = testgen.generation_stats(rows).first()
    assert st.total_chunks == c.count()
    assert st.total_qa_pairs == T.qa(spark, SF001).count()
    assert st.skipped_chunks == rows.where(F.col("qa_pairs_count") == 0).count()


def test_batch_infer_statuses(spark):
    prompts = spark.createDataFrame([("p1", "ok"), ("p2", "boom"), ("p3", "busy")], "prompt_id string, prompt string")

    def call(text):
        if text == "boom":
            raise RuntimeError("connection reset")
        if text == "busy":
            return 503, "x" * 900
        return 200, json.dumps({"predictions": [text.upper()]})

    out = {r.prompt_id: r for r in batch.batch_infer(prompts, call, "2", "run", "ep", partitions=2).collect()}
    assert out["p1"].status == "success" and out["p1"].response == "OK" and out["p1"].error_message is None
    assert out["p2"].status == "error" and out["p2"].error_message == "connection reset"
    assert out["p3"].status == "http_503" and len(out["p3"].error_message) == 500
    assert all(r.latency_ms is not None and r.latency_ms >= 0 for r in out.values())
    again = {r.prompt_id: r.response_id for r in batch.batch_infer(prompts, call, "2", "run", "ep").collect()}
    assert again == {k: v.response_id for k, v in out.items()}


def test_batch_judge_failure_row(spark):
    df = spark.createDataFrame([("p1", "1", "q", "r", "t"), ("p2", "1", "q", "FAILME", None)],
                               "prompt_id string, model_version string, prompt string, response string, "
                               "ground_truth string")

    def call(prompt):
        if "FAILME" in prompt:
            raise RuntimeError("judge down")
        return 200, json.dumps({"choices": [{"message": {"content": '{"score": 5, "reasoning": "good"}'}}]})

    out = {r.prompt_id: r for r in batch.batch_judge(df, call, "judge", "run").collect()}
    assert out["p1"].metric_value == 5.0 and out["p1"].evaluator == "llm_judge:judge"
    assert json.loads(out["p1"].metric_details)["reasoning"] == "good"
    assert out["p2"].metric_value is None and out["p2"].reasoning == "Evaluation failed: judge down"


def test_generate_qa_retries_and_skips(spark):
    chunks = spark.createDataFrame([("1", "a" * 60), ("2", "short"), ("3", "b" * 60)],
                                   "chunk_id string, source_text string")
    attempts = {}

    def gen(text, cid, n):
        attempts[cid] = attempts.get(cid, 0) + 1
        if cid == "3":
            raise RuntimeError("llm error")
        return [(f"q{i}", text[:5]) for i in range(n)]

    out = batch.generate_qa(chunks, gen, pairs_per_chunk=2, retries=3, backoff_s=0.0).collect()
    ok = [r for r in out if r.error is None]
    bad = {r.chunk_id: r for r in out if r.error is not None}
    assert len(ok) == 2 and {r.chunk_id for r in ok} == {"1"}
    assert bad["2"].error.startswith("chunk too short") and bad["3"].attempts == 3


def test_build_testset_composition(spark):
    from evalspark.plans.catalog import digest_generator

    chunks = T.chunks(spark, SF001)
    out = testgen.build_testset(chunks, digest_generator, k=2, backoff_s=0.0)
    qa = T.qa(spark, SF001)
    assert sorted(tuple(r) for r in out["qa"].collect()) == sorted(tuple(r) for r in qa.collect())
    t = out["totals"].first()
    assert t.chunks == chunks.count() and t.qa_pairs == qa.count() and t.skipped == 0
    assert out["retrieval"].count() == qa.count()


def test_judge_to_evals_sample_is_repeatable(spark):
    pairs = T.pairs(spark, SF001)

    def call(prompt):
        return 200, json.dumps({"predictions": ['{"score": 3}']})

    a = {r.prompt_id for r in batch.judge_to_evals(pairs, call, "j", "r", sample_size=5).collect()}
    b = {r.prompt_id for r in batch.judge_to_evals(pairs, call, "j", "r", sample_size=5).collect()}
    assert a == b and len(a) == 5


def test_metrics_to_evals_maps_and_writes_values(spark):
    pairs = T.pairs(spark, SF001)

    def score(scorer, question, output, facts):
        if scorer == "Safety":
            raise RuntimeError("unavailable")
        return float(len(output) % 5) + (0.5 if facts else 0.0)

    out = batch.metrics_to_evals(pairs, ["faithfulness", "safety", "unknown_metric"], score, "r")
    rows = out.collect()
    assert {r.metric_name for r in rows} == {"faithfulness", "safety"}
    assert all(r.metric_value is not None for r in rows if r.metric_name == "faithfulness")
    assert all(r.metric_value is None and "unavailable" in r.metric_details for r in rows
               if r.metric_name == "safety")
    assert len(rows) == 2 * pairs.count()


def test_negatives_stay_in_their_version(spark):
    rows = [(f"c{i}", "v1" if i < 12 else "v2", f"d{i % 4}") for i in range(20)] + [(f"c{i}", "v2", f"d{i % 3}") for i in range(5)]
    df = spark.createDataFrame(rows, "chunk_id string, dataset_version string, source string")
    for buckets in (1, 4):
        got = testgen.hard_negatives(df, k=2, buckets=buckets).collect()
        assert len(got) == 2 * len(rows)
        for v in ("v1", "v2"):
            inside = [(c, d) for c, w, d in rows if w == v]
            by = {}
            for r in sorted((r for r in got if r.dataset_version == v), key=lambda r: r.rank):
                by.setdefault(r.chunk_id, []).append(r.negative_chunk_id)
            assert by == brute_negatives(inside, 2)
    qa = spark.createDataFrame([("c1", "v1", "q"), ("c1", "v2", "q"), ("none", "v1", "q")], "chunk_id string, dataset_version string, question string")
    records = testgen.retrieval_records(qa, testgen.hard_negatives(df, k=2)).collect()
    assert len(records) == 3 and sorted(len(r.hard_negative_chunk_ids) for r in records) == [0, 2, 2]


def test_calls_go_on_where_they_stood(spark, tmp_path):
    """A run that breaks off in its third wave: what was written stays, the next run calls only the rest."""
    from evalspark.session import scratch_path

    flag = tmp_path / "broken"
    flag.write_text("x")
    log = tmp_path / "log"
    log.mkdir()

    def call(prompt):
        import os
        import uuid

        if os.path.exists(flag) and prompt == "prompt 7":
            raise SystemExit("the worker dies")
        (log / uuid.uuid4().hex).write_text(prompt)
        return 200, '{"predictions": ["ok"]}'

    prompts = spark.createDataFrame([(f"p{i}", f"prompt {i}") for i in range(60)], "prompt_id string, prompt string")
    path = scratch_path(spark, "resume")
    arguments = {"created_at": "2024-01-01", "max_workers": 1, "results": path, "rows_per_wave": 10, "partitions": 1}
    with pytest.raises(Exception):  # noqa: B017
        batch.batch_infer(prompts, call, "1", "r", "e", **arguments)
    flag.unlink()
    before = {r.prompt_id for r in spark.read.parquet(path).collect()}
    assert "p7" not in before and len(before) < 60
    seen = {f.name for f in log.iterdir()}
    out = batch.batch_infer(prompts, call, "1", "r", "e", **arguments).collect()
    assert sorted(r.prompt_id for r in out) == sorted(f"p{i}" for i in range(60)) and {r.status for r in out} == {"success"}
    called = [f.read_text() for f in log.iterdir() if f.name not in seen]
    assert sorted(called) == sorted(f"prompt {i}" for i in range(60) if f"p{i}" not in before)
    assert batch.batch_infer(prompts, call, "1", "r", "e", **arguments).count() == 60
    assert len(list(log.iterdir())) == len(seen) + len(called)  # nothing left to call


def test_small_waves_share_spark_jobs(spark):
    """Ten times the waves run in as many Spark jobs and each prompt is called once, also with a budget and a bound on tasks."""
    from evalspark.session import scratch_path

    def run(n, group, **more):
        prompts = spark.range(n).selectExpr("concat('p', id) AS prompt_id", "concat('prompt ', id % 97) AS prompt")
        spark.sparkContext.setJobGroup(group, group)
        try:
            out = batch.batch_infer(prompts, lambda t: (200, '{"predictions": ["ok"]}'), "1", "r", "e", created_at="2024-01-01",
                                    max_workers=1, results=scratch_path(spark, "waves"), rows_per_wave=10, **more)
            jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        return jobs, sorted(r.prompt_id for r in out.collect())

    small, large = run(60, "waves-small"), run(600, "waves-large")
    assert small[1] == sorted(f"p{i}" for i in range(60)) and large[1] == sorted(f"p{i}" for i in range(600))
    assert large[0] <= small[0] + 2
    budget = run(600, "waves-budget", max_waves=2)[1]
    assert 0 < len(budget) < 100 and len(set(budget)) == len(budget)
    assert run(60, "waves-bound", partitions=2)[1] == small[1]


def test_waves_over_several_jobs(spark, monkeypatch):
    monkeypatch.setattr(batch, "TASKS_PER_JOB", 4)
    prompts = spark.range(100).selectExpr("concat('p', id % 90) AS prompt_id", "concat('prompt ', id) AS prompt")
    out = batch.batch_infer(prompts, lambda t: (200, '{"predictions": ["ok"]}'), "1", "r", "e", rows_per_wave=9)
    assert sorted(r.prompt_id for r in out.collect()) == sorted(f"p{i % 90}" for i in range(100))


def test_finished_waves_of_a_broken_job_stay(spark, tmp_path):
    """A job of many waves whose worker dies once four files are written: the next run calls only the rest."""
    flag, path = tmp_path / "broken", tmp_path / "results"
    flag.write_text("x")

    def call(prompt):
        import os

        if os.path.exists(flag) and os.path.isdir(path) and len([f for f in os.listdir(path) if f.endswith(".parquet")]) >= 4:
            raise SystemExit("the worker dies")
        return 200, '{"predictions": ["%s"]}' % os.path.exists(flag)

    prompts = spark.range(400).selectExpr("concat('p', id % 390) AS prompt_id", "concat('prompt ', id) AS prompt")
    arguments = {"created_at": "2024-01-01", "max_workers": 1, "results": str(path), "rows_per_wave": 10}
    with pytest.raises(Exception):  # noqa: B017
        batch.batch_infer(prompts, call, "1", "r", "e", **arguments)
    before = sorted(r._key for r in spark.read.parquet(str(path)).collect())
    assert 0 < len(before) < 400
    flag.unlink()
    out = batch.batch_infer(prompts, call, "1", "r", "e", **arguments).collect()
    assert sorted(r.prompt_id for r in out) == sorted(f"p{i % 390}" for i in range(400))
    assert sorted(r.response_id for r in out if r.response == "True") == before  # those stayed, the others are new
