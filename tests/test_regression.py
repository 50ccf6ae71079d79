"""Mann-Whitney, outcomes and the regression report: brute force on small
inputs, the FIXTURES expectations on the driver tables, edge rows."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from evalspark.functions.normal import two_sided_p_py
from evalspark.operators import regression, stats
from evalspark.sources import tables as T
from tests.conftest import SF001, SF01

EV = "eval_id string, metric_name string, model_version string, metric_value double"


def evals_df(spark, cand, base, metric="m"):
    rows = [(f"c{i}", metric, "2", float(v)) for i, v in enumerate(cand)]
    rows += [(f"b{i}", metric, "1", float(v)) for i, v in enumerate(base)]
    return spark.createDataFrame(rows, EV)


def brute_u(cand, base):
    return sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in cand for y in base)


def brute_asymptotic_p(cand, base):
    n1, n2 = len(cand), len(base)
    allv = sorted(cand + base)
    n = n1 + n2
    ties = {}
    for v in allv:
        ties[v] = ties.get(v, 0) + 1
    tie = sum(t ** 3 - t for t in ties.values())
    u1 = brute_u(cand, base)
    u = max(u1, n1 * n2 - u1)
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - tie / (n * (n - 1))))
    if s == 0:
        return u1, 1.0
    z = (u - n1 * n2 / 2 - 0.5) / s
    return u1, min(1.0, math.erfc(z / math.sqrt(2))) if z >= 0 else 1.0


def brute_exact_p(cand, base):
    n1, n2 = len(cand), len(base)
    u1 = brute_u(cand, base)
    u = max(u1, n1 * n2 - u1)
    allv = list(range(n1 + n2))
    hits = total = 0
    for comb in itertools.combinations(allv, n1):
        s = set(comb)
        uu = sum(1 for x in comb for y in allv if y not in s and x > y)
        total += 1
        hits += uu >= u
    return u1, min(1.0, 2 * hits / total)


@pytest.mark.parametrize("buckets", [1, 4])
def test_mann_whitney_asymptotic_vs_brute_force(spark, buckets):
    rng = random.Random(3)
    for _ in range(4):
        cand = [rng.choice([1, 2, 3, 4, 5, 2.5]) for _ in range(rng.randint(9, 40))]
        base = [rng.choice([1, 2, 3, 4, 5, 2.5]) for _ in range(rng.randint(9, 40))]
        r = stats.mann_whitney(evals_df(spark, cand, base), "2", "1", buckets=buckets).first()
        u1, p = brute_asymptotic_p(cand, base)
        assert r.u_statistic == pytest.approx(u1)
        assert r.p_value == pytest.approx(p, rel=1e-9, abs=1e-15)


def test_mann_whitney_exact_branch(spark):
    rng = random.Random(5)
    for n1, n2 in [(3, 5), (5, 5), (2, 9), (8, 4)]:
        vals = rng.sample(range(1000), n1 + n2)
        cand, base = vals[:n1], vals[n1:]
        r = stats.mann_whitney(evals_df(spark, cand, base), "2", "1", buckets=1).first()
        u1, p = brute_exact_p(cand, base)
        assert r.u_statistic == u1
        assert r.p_value == pytest.approx(p, rel=1e-12)


def test_exact_known_value():
    # 5 vs 5, complete separation: 2/252
    assert stats.exact_two_sided_p(5, 5, 25) == pytest.approx(2 / 252)


def test_size_one_and_all_equal(spark):
    r = stats.mann_whitney(evals_df(spark, [1.0], [1.0, 2.0, 3.0]), "2", "1").first()
    assert r.p_value == 1.0
    r = stats.mann_whitney(evals_df(spark, [2.0] * 12, [2.0] * 15), "2", "1").first()
    assert r.p_value == 1.0


def test_normal_tail_against_erfc():
    for z in [0.0, 0.06, 0.5, 1.14, 1.96, 2.5, 6.5, 7.5, 10.0, 20.0, 36.0]:
        want = math.erfc(z / math.sqrt(2))
        got = two_sided_p_py(z)
        assert got == pytest.approx(want, rel=1e-8, abs=1e-15)


def test_bucketed_ranks_equal_plain_window(spark):
    ev = T.evals(spark, SF001)
    a = {r.metric_name: r for r in stats.mann_whitney(ev, "2", "1", buckets=1).collect()}
    b = {r.metric_name: r for r in stats.mann_whitney(ev, "2", "1", buckets=32).collect()}
    for k in a:
        assert a[k].u_statistic == b[k].u_statistic
        assert a[k].z_score == b[k].z_score


# fixtures: expected comparison (FIXTURES.md, sf0.01)
EXPECTED = {
    "faithfulness": (30064, 29936, -7.192, 20.149, True),
    "judge_score": (30064, 29936, -15.049, 48.186, True),
    "latency_p95": (30064, 29936, 8.315, 16.651, True),
    "answer_relevance": (30064, 29936, -0.512, 1.106, False),
}


def test_regression_report_matches_fixture(spark):
    rep = regression.regression_report(T.evals(spark, SF01), "2", "1", list(EXPECTED))
    rows = {r.metric_name: r for r in rep.collect()}
    for m, (n1, n2, pct, z, reg) in EXPECTED.items():
        r = rows[m]
        assert (r.n_candidate, r.n_baseline) == (n1, n2)
        assert r.pct_change == pytest.approx(pct, abs=1e-3)
        assert r.z_score == pytest.approx(z, abs=1e-3)
        assert r.is_regression is reg
        assert r.outcome == "FAIL"


@pytest.mark.parametrize("metrics,outcome", [
    (["faithfulness", "answer_relevance", "latency_p95"], "WARN"),
    (["answer_relevance"], "PASS"),
    (list(EXPECTED), "FAIL"),
])
def test_outcome_by_metric_set(spark, metrics, outcome):
    rep = regression.regression_report(T.evals(spark, SF01), "2", "1", metrics)
    assert {r.outcome for r in rep.collect()} == {outcome}


def test_insufficient_data_row(spark):
    ev = evals_df(spark, [], [1.0, 2.0, 3.0], metric="only_baseline")
    rep = regression.compare_metrics(ev, "2", "1", ["only_baseline", "absent"]).collect()
    by = {r.metric_name: r for r in rep}
    for m in ("only_baseline", "absent"):
        assert by[m].reason == "Insufficient data"
        assert by[m].candidate_mean is None and by[m].is_regression is None


def test_determine_outcome_cases(spark):
    def outcome(rows, thr=5.0):
        df = spark.createDataFrame(rows, "metric_name string, is_regression boolean, pct_change double")
        return regression.outcome_of(df, thr).first().outcome

    assert outcome([("faithfulness", False, -1.0)]) == "PASS"
    assert outcome([("faithfulness", True, -6.0)]) == "WARN"
    assert outcome([("faithfulness", True, -15.0)]) == "FAIL"
    assert outcome([("faithfulness", None, None)]) == "PASS"


def test_defaults():
    assert regression.THRESHOLD_PCT == 5.0 and regression.P_VALUE_THRESHOLD == 0.05


def test_signed_percent_change_zero_and_negative_baseline(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0)], "c double, b double")
    got = [r[0] for r in df.select(stats.pct_change_signed(F.col("c"), F.col("b"))).collect()]
    assert got == [0.0, -150.0]


def test_separate_run_filters(spark):
    rows = [("a", "m", "2", 1.0, "r2"), ("b", "m", "2", 2.0, "r2"), ("c", "m", "1", 3.0, "r1"),
            ("d", "m", "1", 4.0, "r1"), ("e", "m", "1", 100.0, "other")]
    ev = spark.createDataFrame(rows, EV + ", run_id string")
    r = stats.version_means(ev, "2", "1", ["m"], candidate_run="r2", baseline_run="r1").first()
    assert (r.n_candidate, r.n_baseline, r.baseline_mean) == (2, 2, 3.5)


def test_percentiles_exact(spark):
    vals = [float(v) for v in range(1, 101)]
    ev = evals_df(spark, vals, [1.0, 2.0])
    r = regression.compare_metrics(ev, "2", "1", ["m"]).first()
    assert r.candidate_p50 == pytest.approx(50.5)
    assert r.candidate_p95 == pytest.approx(95.05)


def test_metric_summary_json_keeps_nulls(spark):
    ev = evals_df(spark, [], [1.0], metric="x")
    rep = regression.regression_report(ev, "2", "1", ["x"])
    s = regression.metric_summary_rows(rep).first()
    assert s.outcome_reason == '{"pct_change":null,"p_value":null,"is_regression":null}'
    assert s.dataset_version == "unknown"


@pytest.mark.parametrize("buckets", [1, 4])
def test_exact_percentiles_keep_null_groups(spark, buckets):
    import numpy as np

    from evalspark.operators.ranking import exact_percentiles

    rng = random.Random(9)
    rows = [(rng.choice(["a", None]), rng.choice(["x", None]), float(rng.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, h string, v double")
    got = {(r.g, r.h): (r.p50, r.p95) for r in
           exact_percentiles(df, ["g", "h"], "v", {"p50": 0.5, "p95": 0.95}, buckets=buckets).collect()}
    want = {}
    for key in {(g, h) for g, h, _ in rows}:
        vals = [v for g, h, v in rows if (g, h) == key]
        want[key] = (np.quantile(vals, 0.5), np.quantile(vals, 0.95))
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0]) and got[k][1] == pytest.approx(want[k][1])


def test_nine_vs_nine_uses_asymptotic(spark):
    rng = random.Random(21)
    vals = rng.sample(range(1000), 18)
    cand, base = vals[:9], vals[9:]
    r = stats.mann_whitney(evals_df(spark, cand, base), "2", "1").first()
    u1, p = brute_asymptotic_p(cand, base)
    assert r.u_statistic == u1 and r.p_value == pytest.approx(p, rel=1e-9)


def test_view_percent_change_zero_and_negative_baseline(spark):
    from evalspark.plans.views import pct_change_view

    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (3.0, 2.0)], "c double, b double")
    got = [r[0] for r in df.select(pct_change_view(F.col("c"), F.col("b"))).collect()]
    assert got == [0.0, 0.0, 50.0]


def test_order_bits_order_like_the_values(spark):
    import math
    import random
    import struct

    from pyspark.sql import functions as F
    from pyspark.sql.types import DoubleType, LongType

    from evalspark.operators.ranking import order_bits

    rng = random.Random(3)
    values = [0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan,
              0.1, 0.2, 0.30000000000000004, 2.0, 4.0, 7.999999999999999, 8.0]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [math.nextafter(2.0 ** e, 0.0) for e in range(-1074, 1024, 7)] + [2.0 ** e for e in range(-1074, 1024, 7)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_bits(F.col("v"), DoubleType()).alias("o")).collect()
    for r in rows:
        if not math.isnan(r.v):
            bits = struct.unpack("<Q", struct.pack("<d", abs(r.v)))[0]
            assert r.o == (-bits if r.v < 0 else bits), r.v
    assert {r.o for r in rows if math.isnan(r.v)} == {(1 << 63) - 1}
    assert [r.o for r in spark.range(-3, 3).select(order_bits(F.col("id"), LongType()).alias("o")).collect()] == list(range(-3, 3))


def test_smaller_weight_by_digits_equals_one_window(spark):
    import random

    from pyspark.sql import functions as F

    from evalspark.operators.ranking import smaller_weight

    rng = random.Random(8)
    values = sorted({rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 1e-3), rng.uniform(-1e-300, 1e-300), float(rng.randint(-5, 5))]) for _ in range(800)})
    rows = [(g, v, rng.randint(1, 9)) for g in (None, "a", "b") for v in rng.sample(values, 300)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    one = {(r.g, r.v): r.s for r in smaller_weight(df, ["g"], "v", {"s": "w"}, buckets=1).collect()}
    assert {(r.g, r.v): r.s for r in smaller_weight(df, ["g"], "v", {"s": "w"}).collect()} == one
    for g, v, _ in rows[:200]:
        assert one[g, v] == sum(w for h, u, w in rows if h == g and u < v)
    longs = df.withColumn("v", (F.col("v") * 1000).cast("long")).groupBy("g", "v").agg(F.sum("w").alias("w"))
    assert {tuple(r) for r in smaller_weight(longs, ["g"], "v", {"s": "w"}).collect()} == \
        {tuple(r) for r in smaller_weight(longs, ["g"], "v", {"s": "w"}, buckets=1).collect()}
