"""Property-based checks of the two custom algorithms."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from evalspark.functions.text import lcs_tokens
from evalspark.operators import stats

words = st.lists(st.sampled_from(["a", "b", "c", "d"]), max_size=25)


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if x == y else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


@given(words, words)
@settings(max_examples=300, deadline=None)
def test_lcs_equals_dp(a, b):
    assert lcs_tokens(a, b) == lcs_dp(a, b) == lcs_tokens(b, a)


@given(st.lists(st.integers(0, 6), min_size=2, max_size=30), st.lists(st.integers(0, 6), min_size=2, max_size=30))
@settings(max_examples=25, deadline=None)
def test_rank_sum_matches_pairwise_u(spark_session_for_properties, cand, base):
    spark = spark_session_for_properties
    rows = [(f"c{i}", "m", "2", float(v)) for i, v in enumerate(cand)]
    rows += [(f"b{i}", "m", "1", float(v)) for i, v in enumerate(base)]
    ev = spark.createDataFrame(rows, "eval_id string, metric_name string, model_version string, metric_value double")
    r = stats.mann_whitney(ev, "2", "1", buckets=2, exact=False).first()
    u = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in cand for y in base)
    assert r.u_statistic == u
    assert 0.0 <= r.p_value <= 1.0 and not math.isnan(r.p_value)


def test_exact_p_against_enumeration():
    import itertools

    for m, n in [(1, 1), (2, 5), (3, 4), (5, 6), (7, 7)]:
        sums = [sum(c) - m * (m - 1) // 2 for c in itertools.combinations(range(m + n), m)]
        for u in range(m * n + 1):
            want = min(1.0, 2 * sum(s >= u for s in sums) / math.comb(m + n, m))
            assert abs(stats.exact_two_sided_p(m, n, u) - want) < 1e-12
    # 8 against 20,000 and against a thousand million: exact, and no memory in n
    assert stats.exact_two_sided_p(8, 20_000, 8 * 20_000) == 2 / math.comb(20_008, 8)
    assert 0 < stats.exact_two_sided_p(8, 10**9, 7.9e9) < 1e-6
