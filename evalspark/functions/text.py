"""Text metrics as column expressions.

Everything except the LCS length is a native Spark expression, so it stays
inside whole-stage codegen. The LCS itself is an Arrow-batched pandas UDF
running a bit-parallel algorithm: O(m * n / word) per pair, which keeps
20k-token documents tractable without truncating them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from evalspark.session import ship_package

# The characters Python's str.split()/str.strip() treat as
# whitespace (str.isspace), as a regex class valid in Java and RE2, and as a
# plain character set for btrim.
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NON_WS_RUN = WS_CLASS.replace("[", "[^", 1) + "+"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove all Unicode whitespace at both ends."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def nonempty(c) -> Column:
    """Python truthiness of an optional string: not NULL and not ''."""
    c = _c(c)
    return c.isNotNull() & (F.length(c) > 0)


def exact_match(response, reference) -> Column:
    """1.0 when trimmed, lower-cased texts are equal; NULL/'' -> 0.0."""
    r, g = _c(response), _c(reference)
    same = F.lower(py_strip(r)) == F.lower(py_strip(g))
    return F.when(nonempty(r) & nonempty(g) & same, F.lit(1.0)).otherwise(F.lit(0.0))


def contains_match(response, reference) -> Column:
    """1.0 when lower(response) contains lower(strip(reference))."""
    r, g = _c(response), _c(reference)
    hit = F.lower(r).contains(F.lower(py_strip(g)))
    return F.when(nonempty(r) & nonempty(g) & hit, F.lit(1.0)).otherwise(F.lit(0.0))


def response_length(response) -> Column:
    """length in code points, NULL -> 0."""
    return F.coalesce(F.length(_c(response)), F.lit(0)).cast("double")


def token_count(response) -> Column:
    """number of whitespace-separated tokens, NULL -> 0."""
    return F.coalesce(F.regexp_count(_c(response), F.lit(NON_WS_RUN)), F.lit(0)).cast("double")


def lcs_tokens(a: list, b: list) -> int:
    """Length of the longest common subsequence of two token lists.

    Bit-parallel form: one bit per position of the shorter list, one big-int
    update per token of the longer list.
    """
    if len(a) < len(b):
        a, b = b, a
    n = len(b)
    if n == 0:
        return 0
    masks: dict = {}
    for j, t in enumerate(b):
        masks[t] = masks.get(t, 0) | (1 << j)
    full = (1 << n) - 1
    v = full
    for t in a:
        m = masks.get(t)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _lcs_text(x, y) -> int:
    if not x or not y:
        return 0
    return lcs_tokens(x.lower().split(), y.lower().split())


@F.pandas_udf(LongType())
def lcs_length(response: pd.Series, reference: pd.Series) -> pd.Series:
    """token LCS of lower-cased, whitespace-split texts (NULL -> 0)."""
    return pd.Series([_lcs_text(x, y) for x, y in zip(response, reference)], dtype="int64")


def rouge_l_from_lcs(lcs, response, reference) -> Column:
    """F1 given the LCS column: P = l/|resp|, R = l/|ref|, F1 = 2PR/(P+R)."""
    m, n = token_count(response), token_count(reference)
    lcs = _c(lcs).cast("double")
    p = F.try_divide(lcs, m)
    r = F.try_divide(lcs, n)
    ok = nonempty(response) & nonempty(reference) & (m > 0) & (n > 0)
    return F.when(ok & (p + r > 0), F.try_divide(2 * p * r, p + r)).otherwise(F.lit(0.0))


def rouge_l(response, reference) -> Column:
    """F1: ROUGE-L F1 over whitespace tokens (NULL, empty -> 0.0)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    return rouge_l_from_lcs(lcs_length(_c(response), _c(reference)), _c(response), _c(reference))


def text_metrics(
    df: DataFrame,
    rouge: bool = True,
    match: bool = True,
    length: bool = True,
    response_col: str = "response",
    truth_col: str = "ground_truth",
) -> DataFrame:
    """add the metric columns to ``df`` in one projection.

    A missing truth column is added as a typed NULL string (P8).
    """
    if truth_col not in df.columns:
        df = df.withColumn(truth_col, F.lit(None).cast("string"))
    cols = [F.col(c) for c in df.columns]
    r, g = F.col(response_col), F.col(truth_col)
    if rouge:
        # The LCS is computed once in Python; the ratio stays a native expression.
        ship_package(df.sparkSession)
        df = df.withColumn("_lcs", lcs_length(r, g))
        cols.append(rouge_l_from_lcs(F.col("_lcs"), r, g).alias("rouge_l"))
    if match:
        cols.append(exact_match(r, g).alias("exact_match"))
        cols.append(contains_match(r, g).alias("contains_match"))
    if length:
        cols.append(response_length(r).alias("response_length"))
        cols.append(token_count(r).alias("token_count"))
    return df.select(*cols)
