"""Numeric column helpers that never raise on missing or zero input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL for a zero or NULL denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def share_true(flag: Column) -> Column:
    """Share of rows whose flag is TRUE; NULL counts as a miss."""
    return F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0)))


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over complete pairs, NULL for fewer than two or for no variance."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    n = F.count(px)
    spread = (F.max(px) > F.min(px)) & (F.max(py) > F.min(py))
    sx, sy = F.stddev_pop(px), F.stddev_pop(py)
    covariance = F.covar_pop(px, py)
    return F.when((n > 1) & spread, F.try_divide(covariance, sx * sy))


def age_match(a: Column, b: Column, tolerance: float = 1.0) -> Column:
    """Within tolerance; NULL when either age is unknown."""
    return F.abs(a.cast("double") - b.cast("double")) <= F.lit(float(tolerance))


def f1_columns(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }
