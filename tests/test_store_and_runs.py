"""Versioned upserts, file sources, prompt datasets and run state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from evalspark.operators import datasets, runs
from evalspark.schemas import EVAL_RESULTS, PROMPT_DATASETS, TABLES
from evalspark.session import scratch_path
from evalspark.sources import store
from evalspark.sources import tables as T
from tests.conftest import SF001

TS = dt.datetime(2024, 1, 1)


def prompts_rows(spark, rows, version="v1"):
    df = spark.createDataFrame(rows, "prompt string, ground_truth string")
    return datasets.make_prompts(df, version, {"source": "test"}, created_at="2024-01-01 00:00:00")


def test_content_ids_are_stable(spark):
    a = prompts_rows(spark, [("q1", "a1"), ("q2", None)]).orderBy("prompt").collect()
    b = prompts_rows(spark, [("q1", "a1"), ("q2", None)]).orderBy("prompt").collect()
    assert [r.prompt_id for r in a] == [r.prompt_id for r in b]
    assert a[0].metadata == {"source": "test"}


def prompt_table(spark, name):
    return store.KeyedTable(spark, scratch_path(spark, name), PROMPT_DATASETS, ("prompt_id", "dataset_version"),
                                  "dataset_version")


def test_upsert_idempotence(spark):
    t = prompt_table(spark, "prompts")
    t.create()
    src = prompts_rows(spark, [("q1", "a1"), ("q2", "a2")])
    t.upsert(src)
    once = sorted(tuple(r) for r in t.read().select("prompt_id", "prompt", "ground_truth").collect())
    t.upsert(src)
    twice = sorted(tuple(r) for r in t.read().select("prompt_id", "prompt", "ground_truth").collect())
    assert once == twice and len(once) == 2
    ids = {r.prompt: r.prompt_id for r in src.collect()}
    changed = src.where("prompt = 'q1'").withColumn("ground_truth", F.lit("changed"))
    t.upsert(changed.unionByName(prompts_rows(spark, [("q3", "a3")])))
    now = {r.prompt: r.ground_truth for r in t.read().collect()}
    assert now == {"q1": "changed", "q2": "a2", "q3": "a3"} and t.read().where(F.col("prompt_id") == ids["q1"]).count() == 1


def test_upsert_moves_a_key_between_partitions(spark):
    """One key under a new partition value replaces its old row."""
    schema = StructType([StructField("response_id", StringType()), StructField("v", StringType()), StructField("run_id", StringType())])
    t = store.KeyedTable(spark, scratch_path(spark, "moves"), schema, ("response_id",), "run_id")
    t.upsert(spark.createDataFrame([("r1", "old", "runA"), ("r2", "old", "runA"), ("r3", "old", "runB"), ("r4", "x", None)], schema))
    t.upsert(spark.createDataFrame([("r1", "new", "runC"), ("r3", "new", "runC"), ("r4", "y", "runA")], schema))
    got = sorted(tuple(r) for r in t.read().select("response_id", "v", "run_id").collect())
    assert got == [("r1", "new", "runC"), ("r2", "old", "runA"), ("r3", "new", "runC"), ("r4", "y", "runA")]


def test_upsert_rejects_duplicate_and_null_keys(spark):
    t = prompt_table(spark, "dups")
    dup = prompts_rows(spark, [("same", "a"), ("same", "b")]).withColumn("prompt_id", F.lit("one id"))
    with pytest.raises(store.DuplicateKeyError):
        t.upsert(dup)
    nul = prompts_rows(spark, [("x", "a")]).withColumn("prompt_id", F.lit(None).cast("string"))
    with pytest.raises(store.NullKeyError):
        t.upsert(nul)


def test_equal_prompt_rows_are_one_prompt(spark):
    df = datasets.prompts_from_rows(spark, [{"prompt": "q", "ground_truth": "a"}, {"prompt": "q", "ground_truth": "a"},
                                            {"prompt": "q", "ground_truth": "b"}, {"prompt": "x", "prompt_id": "i"},
                                            {"prompt": "y", "prompt_id": "i"}], "v1")
    assert sorted((r.prompt, r.ground_truth) for r in df.collect() if r.prompt == "q") == [("q", "a"), ("q", "b")]
    with pytest.raises(store.DuplicateKeyError):  # a given id twice is the caller's error
        store.check_keys(df, ["prompt_id"])


def test_evals_fixture_has_duplicate_eval_ids(spark):
    ev = T.evals(spark, SF001)
    with pytest.raises(store.DuplicateKeyError):
        store.check_keys(ev, ["eval_id"])


def test_create_catalog_registers_views(spark):
    tables = store.create_catalog(spark, scratch_path(spark, "catalog"))
    assert set(tables) == set(TABLES)
    assert spark.table("raw_prompt_datasets").count() == 0


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_read_prompts_formats(spark, fmt):
    path = scratch_path(spark, f"src-{fmt}")
    df = spark.createDataFrame([("q1", "a1", "x"), ("q2", None, "y")], "question string, answer string, extra string")
    w = df.write.option("header", "true") if fmt == "csv" else df.write
    w.format(fmt).save(path)
    out = datasets.read_prompts(spark, path, fmt, prompt_col="question", truth_col="answer")
    assert sorted((r.prompt, r.ground_truth) for r in out.collect()) == [("q1", "a1"), ("q2", None)]
    missing = datasets.read_prompts(spark, path, fmt, prompt_col="question", truth_col="nope")
    assert {r.ground_truth for r in missing.collect()} == {None}


def test_versions_and_latest(spark):
    p = T.prompts(spark, SF001)
    vs = {r.dataset_version: r.prompt_count for r in datasets.dataset_versions(p).collect()}
    assert sum(vs.values()) == p.count()
    assert datasets.latest_version(p).first().dataset_version == max(vs)
    empty = datasets.latest_version(p.where("false")).collect()
    assert len(empty) == 1 and empty[0].dataset_version is None
    with pytest.raises(ValueError):
        datasets.load_version(p, "nope", require_nonempty=True)


def test_run_state_latest_wins(spark):
    init = runs.init_run_events(spark, "r1", {"a": 1}, TS, job_id="j")
    upd = runs.update_events(spark, "r1", {"status": "running", "task:inference": "completed",
                                           "output:outcome": "PASS"}, TS + dt.timedelta(minutes=1), 100)
    done = runs.update_events(spark, "r1", {"status": "completed"}, TS + dt.timedelta(minutes=2), 200)
    ev = init.unionByName(upd).unionByName(done)
    st = {r.k: r.v for r in runs.run_state(ev).collect()}
    assert st["status"] == "completed" and st["task:inference"] == "completed" and st["task:alert"] == "pending"
    rec = runs.run_records(ev).first()
    assert rec.status == "completed" and rec.job_id == "j"
    assert rec.completed_at == TS + dt.timedelta(minutes=2)
    assert '"inference":"completed"' in rec.task_state and rec.outputs == '{"outcome":"PASS"}'


def test_json_map_get_set(spark):
    df = spark.createDataFrame([('{"a": "1"}',), (None,)], "j string")
    out = df.select(runs.json_set("j", "a", "2").alias("s"), runs.json_get("j", "a", "none").alias("g")).collect()
    assert out[0].s == '{"a":"2"}' and out[0].g == "1"
    assert out[1].s == '{"a":"2"}' and out[1].g == "none"


def bucket_files(root):
    import os

    return {b: sorted(f for f in os.listdir(f"{root}/rows/{b}") if f.endswith(".parquet"))
            for b in os.listdir(f"{root}/rows") if b.startswith("_bucket=")}


def eval_rows(spark, run, ids, value):
    return spark.createDataFrame([(f"e-{i}", None, "p", "1", run, "m", value, None, "e", None, None) for i in ids], EVAL_RESULTS)


def test_upsert_touches_only_buckets_that_may_hold_its_keys(spark):
    root = scratch_path(spark, "evals-keyed")
    t = store.KeyedTable(spark, root, EVAL_RESULTS, ("eval_id",), "run_id", buckets=16)
    assert t.upsert(eval_rows(spark, "r1", range(400), 1.0))["rewritten"] == []
    before = bucket_files(root)
    assert len(before) == 16 and not any("run_id=" in b for b in before)  # no folder per run
    done = t.upsert(eval_rows(spark, "r2", [3, 5], 2.0))  # known keys come back under another run
    after = bucket_files(root)
    assert 1 <= len(done["rewritten"]) <= 2 and done["added"] == []
    changed = {int(b.split("=")[1]) for b in before if before[b] != after[b]}
    assert changed == set(done["rewritten"])  # no other file was written
    done = t.upsert(eval_rows(spark, "r3", range(1000, 1020), 3.0))  # new keys: files are added, none is rewritten
    assert done["rewritten"] == [] and all(set(after[b]) <= set(bucket_files(root)[b]) for b in after)
    got = {r.eval_id: (r.run_id, r.metric_value) for r in t.read().collect()}
    assert got == {**{f"e-{i}": ("r1", 1.0) for i in range(400)}, "e-3": ("r2", 2.0), "e-5": ("r2", 2.0),
                   **{f"e-{i}": ("r3", 3.0) for i in range(1000, 1020)}}
    # reading some buckets lists and reads no other
    part = t._in_buckets([4])
    assert all("_bucket=4" in f for f in part.inputFiles()) or "_bucket#" in part._jdf.queryExecution().executedPlan().toString()
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_keyed_table_keeps_its_layout_and_ignores_column_types_of_the_key(spark):
    root = scratch_path(spark, "layout")
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    store.KeyedTable(spark, root, schema, ("k",), "v", buckets=3, blocks=1).upsert(spark.createDataFrame([("a", "1"), ("b", "1")], schema))
    again = store.KeyedTable(spark, root, schema, ("k",), "v", buckets=50, blocks=9)
    assert (again.buckets, again.blocks) == (3, 1)
    again.upsert(spark.createDataFrame([("b", "2"), ("c", "2")], schema))
    again.upsert(spark.createDataFrame([], schema))  # an empty source changes nothing
    assert sorted(tuple(r) for r in again.read().collect()) == [("a", "1"), ("b", "2"), ("c", "2")]


def test_bloom_filter_misses_no_key(spark):
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    t = store.KeyedTable(spark, scratch_path(spark, "bloom"), schema, ("k",), "v", buckets=4, blocks=1)
    t.upsert(spark.range(5000).selectExpr("cast(id as string) k", "'x' v"))
    for some in ("0", "4999", "1234"):
        known, new = t.buckets_of(spark.createDataFrame([(some, "y")], schema))
        assert len(known) == 1 and new == []
    unknown = [t.buckets_of(spark.createDataFrame([(f"no-{i}", "y")], schema))[0] for i in range(6)]
    assert sum(map(len, unknown)) < 6


def test_a_bad_load_changes_neither_table(spark):
    from evalspark.operators import testgen

    tables = store.create_catalog(spark, scratch_path(spark, "load"), buckets=2, blocks=1)
    prompts, chunks = tables["raw.prompt_datasets"], tables["metadata.testgen_chunks"]
    rows = spark.createDataFrame([("c1", "v1", "en", "s", "text 1"), ("c2", "v1", "en", "s", "text 2")],
                                 "chunk_id string, dataset_version string, source_collection string, source string, source_text string")
    qa = spark.createDataFrame([("c1", "v1", "q1", "a1"), ("c1", "v1", "q2", "a2")], "chunk_id string, dataset_version string, question string, ground_truth string")
    testgen.load_generated(prompts, chunks, rows, qa, "tg", TS)
    for bad in (rows.unionByName(rows.limit(1)), rows.withColumn("chunk_id", F.when(F.col("chunk_id") == "c1", F.col("chunk_id")))):
        with pytest.raises((store.DuplicateKeyError, store.NullKeyError)):
            testgen.load_generated(prompts, chunks, bad, qa.withColumn("question", F.concat("question", F.lit("!"))), "tg", TS)
    assert sorted(r.prompt for r in prompts.read().collect()) == ["q1", "q2"]
    assert sorted((r.chunk_id, r.qa_pairs_count) for r in chunks.read().collect()) == [("c1", 2), ("c2", 0)]


def test_prompts_from_rows_keeps_row_metadata(spark):
    df = datasets.prompts_from_rows(spark, [{"prompt": "q", "ground_truth": "a", "metadata": {"chunk_id": 7}},
                                            {"prompt": "r", "prompt_id": "given"}], "v9", {"source": "s"})
    rows = {r.prompt: r for r in df.collect()}
    assert rows["q"].metadata == {"source": "s", "chunk_id": "7"} and rows["r"].prompt_id == "given"
    assert rows["q"].dataset_version == "v9" and rows["r"].ground_truth is None


def test_deterministic_sample_is_the_md5_order(spark):
    df = spark.range(0, 3000).selectExpr("cast(id as string) as k", "id % 7 as v")
    for n in (0, 7, 500, 4000):
        got = sorted(r.k for r in datasets.deterministic_sample(df, n, "k").collect())
        assert got == sorted(r.k for r in df.orderBy(F.md5("k")).limit(n).collect())


def test_deterministic_sample_keeps_null_keys(spark):
    rows = [(f"k{i}" if i % 4 else None, i) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = datasets.deterministic_sample(df, 12, "k").collect()
    assert sorted(r.v for r in got) == list(range(12))
    order = sorted(rows, key=lambda r: (__import__("hashlib").md5((r[0] or "").encode()).hexdigest(), r[0] or ""))
    assert [r[0] for r in order[:8]].count(None) == sum(r.k is None for r in datasets.deterministic_sample(df, 8, "k").collect())


def test_append_adds_files_and_keys(spark):
    from pyspark.sql.types import _parse_datatype_string

    root = scratch_path(spark, "events-keyed")
    t = store.KeyedTable(spark, root, _parse_datatype_string(runs.EVENT_SCHEMA), ("event_id",), "run_id", buckets=4)
    t.append(runs.init_run_events(spark, "r1", {}, TS))
    before = bucket_files(root)
    t.append(runs.update_events(spark, "r1", {"status": "running"}, TS, 100))
    assert all(set(before[b]) <= set(bucket_files(root)[b]) for b in before)
    assert {r.v for r in runs.run_state(t.read()).where("k = 'status'").collect()} == {"running"}
    t.upsert(runs.update_events(spark, "r1", {"status": "failed"}, TS, 100))  # an appended key is known
    assert {r.v for r in runs.run_state(t.read()).where("k = 'status'").collect()} == {"failed"}


def test_materialized_paths_are_recorded(spark):
    from evalspark.session import materialize, materialized_paths

    before = len(materialized_paths(spark))
    out = materialize(spark.range(5))
    assert out.count() == 5
    paths = materialized_paths(spark)
    assert len(paths) == before + 1 and paths[-1].startswith(scratch_path(spark, "x").rsplit("/", 1)[0])


def test_cluster_conf_scales_with_input():
    from evalspark.session import cluster_conf

    small = cluster_conf(10 << 20, 8)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_ship_package_once_per_application(spark):
    from evalspark import session

    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED


def test_sample_selection_edges(spark):
    rows = [(f"k{i}" if i % 2 else None, i, {"m": str(i)}) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v int, tags map<string,string>")
    assert datasets.deterministic_sample(df, 0, "k").count() == 0 and datasets.deterministic_sample(df, 999, "k").count() == 200
    import hashlib
    import json

    order = sorted(rows, key=lambda r: (hashlib.md5((r[0] or "").encode()).hexdigest(), r[0] or "",
                                        json.dumps({**({"k": r[0]} if r[0] else {}), "v": r[1], "tags": r[2]}, separators=(",", ":"))))
    for n in (1, 60, 130, 199, 200):
        assert sorted(r.v for r in datasets.deterministic_sample(df, n, "k").collect()) == sorted(r[1] for r in order[:n])
    plan = datasets.deterministic_sample(df, 60, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan  # no ranking of the table


def test_row_metadata_wins_over_batch_metadata(spark):
    df = datasets.prompts_from_rows(spark, [{"prompt": "q", "metadata": {"source": "own", "x": 1}}], "v1", {"source": "batch", "lang": "en"})
    assert df.first().metadata == {"source": "own", "x": "1", "lang": "en"}


def test_csv_fields_with_line_breaks_and_quotes(spark):
    from evalspark.operators import testgen

    said = ' a "quoted" word,\nand\r\na {brace} \\ end '
    rows = spark.createDataFrame([(said, "x"), ("plain", None)], "prompt string, ground_truth string")
    path = testgen.export(rows, scratch_path(spark, "csv"), "csv", rows_per_file=1)
    back = {(r.prompt, r.ground_truth) for r in datasets.read_prompts(spark, path, "csv").collect()}
    assert {p.replace("\r\n", "\n") for p, _ in back} == {said.replace("\r\n", "\n"), "plain"} and (  # the reader may join \r\n
        ("plain", None) in back)
    doubled = scratch_path(spark, "csv-doubled")
    spark.createDataFrame([('prompt,ground_truth',), ('"say ""hi""",t',)], "value string").coalesce(1).write.text(doubled)
    assert datasets.read_prompts(spark, doubled, "csv", csv_escape='"').first().prompt == 'say "hi"'


def test_run_log_reads_a_snapshot_and_what_came_since(spark):
    import os

    def event(run, k, v, second, i):
        return (run, k, v, dt.datetime(2024, 1, 1, 0, 0, second), i)

    def frame(*rows):
        return spark.createDataFrame(list(rows), runs.EVENT_SCHEMA)

    root = scratch_path(spark, "runlog")
    log = runs.RunLog(spark, root)
    assert log.records().count() == 0 and not log.exists("r1")
    log.append(runs.init_run_events(spark, "r1", {"m": 1}, dt.datetime(2024, 1, 1), job_id="j"))
    log.append(frame(event("r1", "status", "running", 10, 100), event("r2", "status", "pending", 3, 101)))
    log.snapshot()
    log.append(frame(event("r1", "output:u", 'a "b"', 20, 102)))
    log.snapshot()
    log.append(frame(event("r1", "status", "completed", 30, 103), event("r1", "status", "failed", 5, 104),  # the second one is late
                     event("r2", "task:inference", "running", 9, 105)))
    got = {r.run_id: r for r in log.records().collect()}
    r1 = got["r1"]
    assert (r1.status, r1.job_id, r1.outputs) == ("completed", "j", '{"u":"a \\"b\\""}') and '"inference":"pending"' in r1.task_state
    assert (r1.created_at, r1.updated_at, r1.completed_at) == tuple(dt.datetime(2024, 1, 1, 0, 0, s) for s in (0, 30, 30))
    assert got["r2"].status == "pending" and got["r2"].task_state == '{"inference":"running"}' and got["r2"].completed_at is None
    assert log.exists("r2") and not log.exists("r3")
    # the events of the first epoch are not read any more
    plan = log.state()._jdf.queryExecution().executedPlan().toString()
    assert "/snapshots/2" in plan and "/snapshots/1" not in plan
    assert "(epoch" in plan.split("PartitionFilters: [")[1].split("]")[0] + plan.split("PartitionFilters: [")[-1].split("]")[0]
    assert sorted(os.listdir(f"{root}/snapshots")) == ["1", "2"]
    log.append(frame(event("r9", "status", "done", 40, 200)))
    with pytest.raises(Exception, match="unknown run status"):
        log.records().collect()


def test_ordered_read_gives_the_global_place(spark):
    from evalspark.plans import views

    rows = spark.range(500).selectExpr("concat('m', id % 7) AS model_version", "'s' AS status", "id * 37 % 101 AS error_count",
                                       "concat('e', id) AS error_message")
    rows.createOrReplaceTempView("t1_error_analysis")
    got = views.read_view(spark, "error_analysis", "t1_").collect()
    want = sorted(rows.collect(), key=lambda r: (-r.error_count, r.model_version, r.status, r.error_message))
    assert [r.position for r in got] == list(range(1, 501)) and [r.error_message for r in got] == [r.error_message for r in want]


def test_eval_rows_without_a_response_id_show_once(spark):
    from evalspark.plans import views

    ev = spark.createDataFrame([(None, "p", "1", "m", 0.5, "e")], "response_id string, prompt_id string, model_version string, "
                               "metric_name string, metric_value double, evaluator string")
    resp = spark.createDataFrame([("r1", "p", "1", "old", TS), ("r2", "p", "1", "new", TS + dt.timedelta(days=1))],
                                 "response_id string, prompt_id string, model_version string, response string, created_at timestamp")
    prompts = spark.createDataFrame([("p", "q", "t")], "prompt_id string, prompt string, ground_truth string")
    got = views.prompt_scores(ev, resp, prompts).collect()
    assert [r.response for r in got] == ["new"]
