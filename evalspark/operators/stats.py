"""Two-sample statistics on the long evaluation table.

One scan and one partially aggregated shuffle: evals collapse to
``(metric, value) -> (c = candidate rows, t = all rows)``. Means, population
standard deviations, exact candidate percentiles and the Mann-Whitney rank sum
are all computed from that distinct-value table; only one row per metric
leaves the executors.
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from evalspark.functions.normal import two_sided_p_sql
from evalspark.operators.ranking import buckets_for, join_on_keys, smaller_weight
from evalspark.session import materialize, ship_package

EXACT_MAX_SMALL = 8


def value_counts(
    evals: DataFrame,
    candidate: str,
    baseline: str,
    metrics: list[str] | None = None,
    candidate_run: str | None = None,
    baseline_run: str | None = None,
    metric_col: str = "metric_name",
    value_col: str = "metric_value",
    version_col: str = "model_version",
) -> DataFrame:
    """Rows of both versions (optionally each filtered by its own
    run id, T4), NULL values dropped, collapsed to (metric, value, c, t)."""
    cand = F.col(version_col) == candidate
    base = F.col(version_col) == baseline
    if candidate_run is not None:
        cand = cand & (F.col("run_id") == candidate_run)
    if baseline_run is not None:
        base = base & (F.col("run_id") == baseline_run)
    df = evals.where((cand | base) & F.col(value_col).isNotNull())
    if metrics is not None:
        df = df.where(F.col(metric_col).isin(list(metrics)))
    return (
        df.select(F.col(metric_col).alias("metric_name"), F.col(value_col).cast("double").alias("v"),
                  F.when(cand, 1).otherwise(0).alias("_is_c"), F.when(base, 1).otherwise(0).alias("_is_b"))
        .groupBy("metric_name", "v")
        .agg(F.sum("_is_c").cast("long").alias("c"), F.sum("_is_b").cast("long").alias("b"))
        .withColumn("t", F.col("c") + F.col("b"))
    )


def _percentile_at(p: float, n: Column, before: Column, w: Column, v: Column):
    """Exact interpolated percentile pieces over a weighted distinct table."""
    h = F.lit(Decimal(repr(p))) * (n - 1)  # exact decimal position
    lo, hi = F.floor(h), F.ceil(h)
    cov = lambda k: (w > 0) & (before <= k) & (k < before + w)
    return F.max(F.when(cov(lo), v)), F.max(F.when(cov(hi), v)), (h - lo).cast("double")


def count_facts(counts: DataFrame) -> tuple[int, bool]:
    """One row about the distinct-value table, however many metrics it has:
    how the exact ranks are counted (by the largest metric), and whether any
    metric takes SciPy's exact branch (no ties, a sample <= 8)."""
    by_metric = counts.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.sum("c").alias("n1"), F.sum("b").alias("n2"), F.max("t").alias("tmax"))
    small = (F.col("n1") >= 2) & (F.col("n2") >= 2) & (F.least("n1", "n2") <= EXACT_MAX_SMALL) & (F.col("tmax") <= 1)
    largest, exact = by_metric.agg(F.max("distinct_values"), F.coalesce(F.bool_or(small), F.lit(False))).first()
    return buckets_for(largest or 0), exact


def rank_summary(counts: DataFrame, buckets: int | None = None, percentiles: bool = True,
                 materialize_counts: bool = True) -> DataFrame:
    """Per metric: sizes, means, population std, rank sum R1 of the candidate,
    tie term and (optionally) exact candidate p50/p95.

    The distinct-value table is read by several branches (split points,
    bucket totals, local ranks, sizes); it is written once so the raw scan
    and its shuffle run a single time.
    """
    if materialize_counts:
        counts = materialize(counts)
    ranked = smaller_weight(counts, ["metric_name"], "v", {"_bt": "t", "_bc": "c"}, buckets=buckets)
    sizes = counts.groupBy("metric_name").agg(
        F.sum("c").alias("n1"), F.sum("b").alias("n2"),
        F.sum(F.col("c") * F.col("v")).alias("_s1"), F.sum(F.col("b") * F.col("v")).alias("_s2"),
    )
    r = join_on_keys(ranked, sizes, ["metric_name"])
    rank = F.col("_bt") + (F.col("t") + 1) / 2.0
    t = F.col("t").cast("double")
    mean1 = F.try_divide(F.col("_s1"), F.col("n1"))
    mean2 = F.try_divide(F.col("_s2"), F.col("n2"))
    aggs = [
        F.first("n1").alias("n1"), F.first("n2").alias("n2"),
        F.first(mean1).alias("candidate_mean"), F.first(mean2).alias("baseline_mean"),
        F.sum(F.col("c") * rank).alias("r1"),
        F.sum(t * t * t - t).alias("tie"),
        F.sum(F.col("c") * (F.col("v") - mean1) * (F.col("v") - mean1)).alias("_ss1"),
        F.sum(F.col("b") * (F.col("v") - mean2) * (F.col("v") - mean2)).alias("_ss2"),
    ]
    if percentiles:
        for name, p in (("p50", 0.5), ("p95", 0.95)):
            lo, hi, f = _percentile_at(p, F.col("n1"), F.col("_bc"), F.col("c"), F.col("v"))
            aggs += [lo.alias(f"_{name}_lo"), hi.alias(f"_{name}_hi"), F.max(f).alias(f"_{name}_f")]
    out = r.groupBy("metric_name").agg(*aggs)
    out = out.withColumn("candidate_std", F.sqrt(F.try_divide(F.col("_ss1"), F.col("n1")))) \
             .withColumn("baseline_std", F.sqrt(F.try_divide(F.col("_ss2"), F.col("n2"))))
    if percentiles:
        for name in ("p50", "p95"):
            lo, hi, f = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_f")
            out = out.withColumn(f"candidate_{name}", lo + (hi - lo) * f)
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def _period_terms(m: int) -> tuple[int, list[int]]:
    """1 / ((1 - q)(1 - q)(1 - q^2)...(1 - q^m)) = N(q) / (1 - q^L)^(m + 1)
    with L = lcm(1..m): L and the coefficients of N."""
    period = math.lcm(*range(1, m + 1))
    poly = [1]
    for i in (1, *range(1, m + 1)):  # times (1 - q^L) / (1 - q^i) = 1 + q^i + ... + q^(L - i)
        out = [0] * (len(poly) + period - i)
        for j in range(len(out)):
            out[j] = (out[j - i] if j >= i else 0) + (poly[j] if j < len(poly) else 0) \
                - (poly[j - period] if 0 <= j - period < len(poly) else 0)
        poly = out
    return period, poly


def lower_count(m: int, n: int, most: int) -> int:
    """Arrangements of samples of m and n values (no ties) with U <= ``most``:
    inclusion-exclusion over the 2^m products of (1 - q^(n + i)), in exact
    integers; time and memory do not grow with n."""
    if most < 0:
        return 0
    period, poly = _period_terms(m)
    signs: dict[int, int] = {0: 1}
    for i in range(1, m + 1):
        for at, s in list(signs.items()):
            signs[at + n + i] = signs.get(at + n + i, 0) - s
    total = 0
    for at, sign in signs.items():
        left = most - at
        if left < 0 or not sign:
            continue
        total += sign * sum(poly[j] * math.comb((left - j) // period + m, m) for j in range(left % period, min(left + 1, len(poly)), period))
    return total


def exact_two_sided_p(n1: int, n2: int, u: float) -> float:
    """SciPy's exact two-sided p: 2 * P(U >= u), capped at 1. The smaller
    sample has at most EXACT_MAX_SMALL values."""
    m, n = min(n1, n2), max(n1, n2)
    tail = lower_count(m, n, m * n - int(math.ceil(u)))  # U and m n - U are distributed alike
    return min(1.0, float(Fraction(2 * tail, math.comb(m + n, m))))


@F.pandas_udf(DoubleType())
def _exact_p_udf(n1: pd.Series, n2: pd.Series, u: pd.Series, tie: pd.Series) -> pd.Series:
    out = []
    for a, b, uu, tt in zip(n1, n2, u, tie):
        if a is None or b is None or pd.isna(uu) or a < 2 or b < 2 or min(a, b) > EXACT_MAX_SMALL or tt > 0:
            out.append(None)
        else:
            out.append(exact_two_sided_p(int(a), int(b), float(uu)))
    return pd.Series(out, dtype="float64")


def mann_whitney_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """From (n1, n2, r1, tie) add u_statistic (candidate U), z_score and
    p_value with SciPy's two-sided, continuity-corrected rules. ``exact``
    attaches the Python exact-p helper (callers pass ``count_facts``'s flag,
    so it only starts when some metric qualifies)."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    df = df.withColumn("u_statistic", u1)
    u = F.greatest(u1, n1 * n2 - u1)
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie"), n * (n - 1))))
    df = df.withColumn("_u", u).withColumn("_sigma", sigma)
    df = df.withColumn(
        "z_score",
        F.when((F.col("n1") >= 2) & (F.col("n2") >= 2) & (F.col("_sigma") > 0),
               F.try_divide(F.col("_u") - n1 * n2 / 2.0 - 0.5, F.col("_sigma"))),
    )
    asym = F.when((F.col("n1") < 2) | (F.col("n2") < 2), F.lit(1.0)) \
            .when(F.col("z_score").isNull(), F.lit(1.0)) \
            .otherwise(F.expr(two_sided_p_sql("z_score")))
    if exact:
        ship_package(df.sparkSession)
        df = df.withColumn("_exact", _exact_p_udf(F.col("n1"), F.col("n2"), F.col("_u"), F.col("tie")))
        df = df.withColumn("p_value", F.coalesce(F.col("_exact"), asym)).drop("_exact")
    else:
        df = df.withColumn("p_value", asym)
    return df.drop("_u", "_sigma")


def mann_whitney(
    evals: DataFrame,
    candidate: str,
    baseline: str,
    metrics: list[str] | None = None,
    candidate_run: str | None = None,
    baseline_run: str | None = None,
    buckets: int | None = None,
    exact: bool = True,
) -> DataFrame:
    """Per metric n_candidate, n_baseline, U, z and two-sided p."""
    counts = materialize(value_counts(evals, candidate, baseline, metrics, candidate_run, baseline_run))
    auto, needs_exact = count_facts(counts)
    s = rank_summary(counts, buckets=auto if buckets is None else buckets, percentiles=False,
                     materialize_counts=False)
    s = mann_whitney_columns(s, exact=exact and needs_exact)
    return s.select(
        "metric_name", F.col("n1").alias("n_candidate"), F.col("n2").alias("n_baseline"),
        "u_statistic", "z_score", "p_value",
    )


def pct_change_signed(c: Column, b: Column) -> Column:
    """(c - b) / b * 100 with the signed baseline; 0 when b == 0."""
    return F.when(b.isNull() | c.isNull(), F.lit(None).cast("double")) \
            .when(b != 0, (c - b) / b * 100.0).otherwise(F.lit(0.0))


def version_means(
    evals: DataFrame,
    candidate: str,
    baseline: str,
    metrics: list[str] | None = None,
    candidate_run: str | None = None,
    baseline_run: str | None = None,
) -> DataFrame:
    """Mean, population std and size per version, signed % change.

    Native ``avg``/``stddev_pop`` over the raw rows, one partial aggregation.
    """
    cand = F.col("model_version") == candidate
    base = F.col("model_version") == baseline
    if candidate_run is not None:
        cand = cand & (F.col("run_id") == candidate_run)
    if baseline_run is not None:
        base = base & (F.col("run_id") == baseline_run)
    df = evals.where((cand | base) & F.col("metric_value").isNotNull())
    if metrics is not None:
        df = df.where(F.col("metric_name").isin(list(metrics)))
    v = F.col("metric_value").cast("double")
    out = df.groupBy("metric_name").agg(
        F.avg(F.when(cand, v)).alias("candidate_mean"),
        F.avg(F.when(base, v)).alias("baseline_mean"),
        F.stddev_pop(F.when(cand, v)).alias("candidate_std"),
        F.stddev_pop(F.when(base, v)).alias("baseline_std"),
        F.count(F.when(cand, v)).alias("n_candidate"),
        F.count(F.when(base, v)).alias("n_baseline"),
    )
    return out.withColumn("pct_change", pct_change_signed(F.col("candidate_mean"), F.col("baseline_mean")))
