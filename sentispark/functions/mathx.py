"""Math expressions shared by the Spark plans and the SQL oracle.

Neither Spark nor DuckDB has ``erf``, so the standard normal CDF is written
out once as SQL text (W. J. Cody / J. F. Hart's rational approximation in
the double-precision form published by G. West, "Better approximations to
cumulative normal functions", Wilmott 2005).  The same text is used through
``F.expr`` in Spark and verbatim in the DuckDB oracle, so both engines
evaluate the same formula.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed coefficients of the published approximation, in its order.
_NUM = ("3.52624965998911E-02", "0.700383064443688", "6.37396220353165",
        "33.912866078383", "112.079291497871", "221.213596169931", "220.206867912376")
_DEN = ("8.83883476483184E-02", "1.75566716318264", "16.064177579207", "86.7807322029461",
        "296.564248779674", "637.333633378831", "793.826512519948", "440.413735824752")
_SPLIT = "7.07106781186547"
_CUTOFF = "37"
_SQRT_2PI = "2.506628274631"


def _d(s: str) -> str:
    return f"CAST({s} AS DOUBLE)"


def _horner(coeffs: tuple[str, ...], x: str) -> str:
    acc = _d(coeffs[0])
    for c in coeffs[1:]:
        acc = f"({acc} * {x} + {_d(c)})"
    return acc


def normcdf_sql(z: str) -> str:
    """SQL text of Phi(z) for a double expression ``z`` (null stays null)."""
    a = f"abs({z})"
    e = f"exp(-{a} * {a} / {_d('2')})"
    near = f"({e} * {_horner(_NUM, a)} / {_horner(_DEN, a)})"
    far_den = f"({a} + {_d('0.65')})"
    for k in ("4", "3", "2", "1"):
        far_den = f"({a} + {_d(k)} / {far_den})"
    far = f"({e} / {far_den} / {_d(_SQRT_2PI)})"
    tail = (f"(CASE WHEN {a} > {_d(_CUTOFF)} THEN {_d('0')} "
            f"WHEN {a} < {_d(_SPLIT)} THEN {near} ELSE {far} END)")
    return f"(CASE WHEN {z} IS NULL THEN NULL WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END)"


def normcdf_expr(x: str, mean: str, std: str) -> str:
    """SQL text of Phi((x - mean) / std); null when std is 0 or null."""
    z = f"(({x} - {mean}) / nullif({std}, 0))"
    return normcdf_sql(z)


def hmean2_sql(a: str, b: str) -> str:
    """Harmonic mean of two numbers, 0 unless both are positive."""
    return f"(CASE WHEN {a} > 0 AND {b} > 0 THEN 2 * {a} * {b} / ({a} + {b}) ELSE {_d('0')} END)"


def hmean2(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), 2 * a * b / (a + b)).otherwise(F.lit(0.0))
