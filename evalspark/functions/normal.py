"""Two-sided normal tail probability as a plain SQL expression.

Neither Spark nor DuckDB ships ``erf``; West (2005, "Better approximations to
cumulative normal functions", Wilmott) gives a double-precision rational form
that only needs exp, + and *, so the same text runs in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart/West coefficients, highest degree first.
NUMERATOR = (
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
DENOMINATOR = (
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)
SPLIT = 7.07106781186547
SQRT_2PI = 2.506628274631
UNDERFLOW = 37.0


def _horner(coeffs: tuple, z: str) -> str:
    expr = repr(coeffs[0])
    for c in coeffs[1:]:
        expr = f"({expr}) * {z} + {c!r}"
    return expr


def two_sided_p_sql(z: str) -> str:
    """SQL text for min(1, 2 * Q(z)); 1 for z < 0, 0 beyond the underflow point."""
    e = f"exp(-({z}) * ({z}) / 2.0)"
    inner = f"2.0 * {e} * ({_horner(NUMERATOR, z)}) / ({_horner(DENOMINATOR, z)})"
    cf = f"({z}) + 1.0 / (({z}) + 2.0 / (({z}) + 3.0 / (({z}) + 4.0 / (({z}) + 0.65))))"
    tail = f"2.0 * {e} / ({cf}) / {SQRT_2PI!r}"
    return (
        f"CASE WHEN {z} IS NULL THEN NULL WHEN {z} < 0 THEN 1.0 "
        f"WHEN {z} < {SPLIT!r} THEN least(1.0, {inner}) "
        f"WHEN {z} <= {UNDERFLOW!r} THEN {tail} ELSE 0.0 END"
    )


def two_sided_p(z_col: str) -> Column:
    """Column form of :func:`two_sided_p_sql` over a named column."""
    return F.expr(two_sided_p_sql(f"`{z_col}`"))


def two_sided_p_py(z: float) -> float:
    """The same approximation in Python (tests and the exact-U helper)."""
    import math

    if z < 0:
        return 1.0
    if z > UNDERFLOW:
        return 0.0
    e = math.exp(-z * z / 2.0)
    if z < SPLIT:
        num = NUMERATOR[0]
        for c in NUMERATOR[1:]:
            num = num * z + c
        den = DENOMINATOR[0]
        for c in DENOMINATOR[1:]:
            den = den * z + c
        return min(1.0, 2.0 * e * num / den)
    cf = z + 1.0 / (z + 2.0 / (z + 3.0 / (z + 4.0 / (z + 0.65))))
    return 2.0 * e / cf / SQRT_2PI
