"""Python-exact decimal rounding as native column arithmetic.

Python's ``round(x, n)`` and ``'%.nf'`` round the *exact binary value* of a
double half-to-even, so ``round(0.15, 1) == 0.1`` (0.15 is stored just below
0.15).  Spark's ``bround``/``format_string`` round the shortest decimal text
instead and give 0.2.  Plans and reports must match the reproduced behaviour,
so :func:`py_round` decides ties exactly:

``y = fl(x·10ⁿ)`` carries a rounding error ``e`` that Dekker's two-product
recovers exactly with plain double operations; the fraction ``y - floor(y)``
together with the sign of ``e`` tells on which side of the half the exact
product lies.  The result ``r / 10ⁿ`` is a correctly rounded division, equal to
Python's result.  Everything stays in codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1 (Veltkamp split of a double)


def _split(a: Column) -> tuple[Column, Column]:
    c = F.lit(_SPLIT) * a
    hi = c - (c - a)
    return hi, a - hi


def py_round(x: Column, ndigits: int = 0) -> Column:
    s = float(10 ** ndigits)
    xs = x.cast("double")
    y = xs * F.lit(s)
    xh, xl = _split(xs)
    sh, sl = _split(F.lit(s))
    err = ((xh * sh - y) + xh * sl + xl * sh) + xl * sl
    f = F.floor(y).cast("double")
    d = y - f
    up = (d > 0.5) | ((d == 0.5) & (err > 0)) | ((d == 0.5) & (err == 0) & (F.pmod(f, F.lit(2.0)) == 1.0))
    r = F.when(up, f + 1.0).otherwise(f)
    return F.when(xs.isNull() | F.isnan(xs), xs).otherwise(r / F.lit(s))


def py_fixed(x: Column, ndigits: int) -> Column:
    """Text of ``f'{x:.nf}'`` (exact half-even), e.g. for report strings."""
    return F.format_string(f"%.{ndigits}f", py_round(x, ndigits))


def py_round_sql(x: str, ndigits: int = 0) -> str:
    """The same algorithm as SQL text (used by the DuckDB oracle)."""
    def dbl(v: float) -> str:  # a double literal (a plain decimal literal would be DECIMAL in SQL)
        r = repr(float(v))
        return r if "e" in r else r + "e0"

    s = dbl(10 ** ndigits)
    sp = dbl(_SPLIT)
    return f"""(SELECT CASE WHEN xs IS NULL THEN NULL
  WHEN (d > 0.5 OR (d = 0.5 AND err > 0) OR (d = 0.5 AND err = 0 AND (f - 2 * floor(f / 2)) = 1)) THEN (f + 1) / {s}
  ELSE f / {s} END
 FROM (SELECT xs, y - floor(y) AS d, floor(y) AS f, ((xh * sh - y) + xh * sl + xl * sh) + xl * sl AS err
  FROM (SELECT xs, y, xh, xs - xh AS xl, sh, {s} - sh AS sl
   FROM (SELECT xs, xs * {s} AS y, ({sp} * xs) - (({sp} * xs) - xs) AS xh,
                ({sp} * {s}) - (({sp} * {s}) - {s}) AS sh
         FROM (SELECT CAST({x} AS DOUBLE) AS xs)))))"""
