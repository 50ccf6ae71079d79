"""Exact prefix counts over sorted values without one task per group.

``Window.partitionBy(g).orderBy(v)`` sends every distinct value of a group to
a single task, which is the bottleneck when one metric carries billions of
distinct values. Here a value's order-preserving 64 bits (the IEEE bits of a
double, by arithmetic; an integer as it is) are cut into three digits of 22,
22 and 20 bits, and the count of smaller values is added up digit by digit:

1. totals of each cell (first two digits), then of each first digit;
2. a running sum over the first digits of a group (at most 2^22 rows), over the
   second digits of a first digit (at most 2^22) and over the values of a cell
   (at most 2^20): no window grows with the group;
3. the three sums of a value make its exact count of smaller values.

Nothing is sampled, written or counted beforehand: the plan is lazy, and a view
built on it sees rows that arrive later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

TARGET_ROWS_PER_WINDOW = 131_072
DIGIT_BITS = (22, 22, 20)


def buckets_for(largest: int, target_rows: int = TARGET_ROWS_PER_WINDOW) -> int:
    """1 where the largest group (known beforehand) fits one window, else 2:
    by digits."""
    return 1 if int(largest) <= target_rows else 2


def order_bits(value: Column, kind: DataType) -> Column:
    """A long that orders like ``value`` (NaN last, as Spark orders it)."""
    if isinstance(kind, IntegralType):
        return value.cast("long")
    v = value.cast("double")
    size = F.abs(v)
    normal = (size > 0) & (size < float("inf"))
    guess = F.greatest(F.floor(F.log2(F.when(normal, size).otherwise(1.0))), F.lit(-1022))
    scaled = size * F.pow(F.lit(2.0), -guess)  # exact; the logarithm may be one off
    power = F.when(scaled >= 2, guess + 1).when((scaled < 1) & (guess > -1022), guess - 1).otherwise(guess)
    part = size * F.pow(F.lit(2.0), -power)
    unit = F.lit(1 << 52)
    bits = F.when(size == 0, F.lit(0)).when(part < 1, F.floor(part * unit)).otherwise((power + 1023) * unit + F.floor((part - 1) * unit))
    bits = F.when(F.isnan(v), F.lit((1 << 63) - 1)).when(size == float("inf"), F.lit(2047 << 52)).otherwise(bits.cast("long"))
    return F.when(v < 0, -bits).otherwise(bits)


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL matches NULL (group keys may be
    NULL: ``groupBy`` and windows keep such groups, a plain equi-join would
    drop them). Still an equi-join for the planner (``<=>``)."""
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_rk_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond).drop(*[f"_rk_{k}" for k in keys])


def smaller_weight(
    df: DataFrame,
    keys: list[str],
    value: str,
    weights: dict[str, str],
    buckets: int | None = None,
) -> DataFrame:
    """For each ``out -> weight`` in ``weights`` add ``out`` = sum of
    ``weight`` over rows of the same ``keys`` whose ``value`` is strictly
    smaller. ``df`` holds one row per (keys, value). ``buckets=1`` takes one
    window per group (for groups known to be small), anything else digits."""
    unb = Window.unboundedPreceding
    if buckets is not None and buckets <= 1:
        w = Window.partitionBy(*keys).orderBy(value).rowsBetween(unb, -1)
        for out, wt in weights.items():
            df = df.withColumn(out, F.coalesce(F.sum(wt).over(w), F.lit(0)))
        return df

    bits = df.withColumn("_o", order_bits(F.col(value), df.schema[value].dataType))
    low = DIGIT_BITS[2]
    tagged = bits.withColumn("_d1", F.shiftright("_o", low + DIGIT_BITS[1])) \
        .withColumn("_d2", F.shiftright("_o", low).bitwiseAND(F.lit((1 << DIGIT_BITS[1]) - 1))).drop("_o")
    cells = tagged.groupBy(*keys, "_d1", "_d2").agg(*[F.sum(wt).alias(f"_w_{o}") for o, wt in weights.items()])
    tops = cells.groupBy(*keys, "_d1").agg(*[F.sum(f"_w_{o}").alias(f"_w_{o}") for o in weights])

    def running(rows: DataFrame, inside: list[str], digit: str, end: str) -> DataFrame:
        w = Window.partitionBy(*inside).orderBy(digit).rowsBetween(unb, -1)
        return rows.select(*inside, digit, *[F.coalesce(F.sum(f"_w_{o}").over(w), F.lit(0)).alias(f"_{end}_{o}") for o in weights])

    offsets = join_on_keys(running(cells, [*keys, "_d1"], "_d2", "b"), running(tops, keys, "_d1", "a"), [*keys, "_d1"])
    wl = Window.partitionBy(*keys, "_d1", "_d2").orderBy(value).rowsBetween(unb, -1)
    local = tagged.select("*", *[F.coalesce(F.sum(wt).over(wl), F.lit(0)).alias(f"_c_{o}") for o, wt in weights.items()])
    out = join_on_keys(local, offsets, [*keys, "_d1", "_d2"])
    return out.select(*df.columns, *[(F.col(f"_a_{o}") + F.col(f"_b_{o}") + F.col(f"_c_{o}")).alias(o) for o in weights])


def _covers(k):
    """Row whose value occupies 0-based sorted position ``k``."""
    return (F.col("_before") <= k) & (k < F.col("_before") + F.col("_t"))


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    buckets: int | None = None,
) -> DataFrame:
    """Exact interpolated percentiles (``percentile`` / ``quantile_cont``
    semantics) per group, computed from value counts and prefix sums instead
    of holding a group's values in one aggregation buffer; with the group's
    ``mean``, sample ``std`` and ``count`` from the same counts.

    Lazy: the raw rows are read once, by the shuffle of the value counts that
    all branches share.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_t"))
    ranked = smaller_weight(counts, keys, value, {"_before": "_t"}, buckets=buckets)
    sizes = counts.groupBy(*keys).agg(F.sum("_t").alias("_n"), (F.sum(F.col(value) * F.col("_t")) / F.sum("_t")).alias("_mean"))
    r = join_on_keys(ranked, sizes, keys)
    off = F.col(value) - F.col("_mean")
    exprs = [F.first("_mean").alias("mean"), F.first("_n").alias("count"), F.sum(off * off * F.col("_t")).alias("_ss")]
    for name, p in probs.items():
        h = F.lit(p) * (F.col("_n") - 1)
        lo, hi = F.floor(h), F.ceil(h)
        exprs += [
            F.max(F.when(_covers(lo), F.col(value))).alias(f"{name}__lo"),
            F.max(F.when(_covers(hi), F.col(value))).alias(f"{name}__hi"),
            F.max(h - lo).alias(f"{name}__f"),
        ]
    out = r.groupBy(*keys).agg(*exprs)
    for name in probs:
        lo, hi, f = F.col(f"{name}__lo"), F.col(f"{name}__hi"), F.col(f"{name}__f")
        out = out.withColumn(name, lo * (1 - f) + hi * f).drop(f"{name}__lo", f"{name}__hi", f"{name}__f")
    return out.withColumn("std", F.sqrt(F.try_divide(F.col("_ss"), F.col("count") - 1))).drop("_ss")
