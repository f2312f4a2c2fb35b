"""Aggregate expressions that are safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over complete (a, b) pairs; NULL when undefined.

    ``corr`` raises DIVIDE_BY_ZERO on a constant series under ANSI; this form
    returns NULL there (and for fewer than two pairs). Algebraic: partial
    aggregation applies, so a hot group never sits in one task.
    """
    x, y = _c(a), _c(b)
    xp = F.when(y.isNotNull(), x)
    yp = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xp, yp), F.stddev_pop(xp) * F.stddev_pop(yp))


def zscore(x: Column | str, mean: Column | str, sd: Column | str) -> Column:
    return F.try_divide(_c(x) - _c(mean), _c(sd))
