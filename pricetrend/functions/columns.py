"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(num, den)


def full_window(value: Column, count_col: Column, n: int) -> Column:
    """NULL unless the frame held ``n`` non-null observations.

    Spark aggregates partial frames at the start of a series; the indicator
    definitions leave those positions missing (min_periods == window).
    """
    return F.when(count_col >= F.lit(n), value)


def rounded(c: Column, digits: int = 6) -> Column:
    """Round for comparison output as ``round(x * 10^d) / 10^d``.

    Scaling first makes the result depend on the binary value only (not on
    its shortest decimal text), so any engine doing the same IEEE steps gets
    the same double; ``+ 0.0`` folds a negative zero.
    """
    m = F.lit(float(10 ** digits))
    return F.round(c * m) / m + F.lit(0.0)


def sign_label(c: Column) -> Column:
    """1 if strictly positive, else 0 (NULL counts as not positive)."""
    return F.when(c > 0, F.lit(1)).otherwise(F.lit(0))
