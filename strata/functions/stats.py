"""Statistics and labelling expressions."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Aggregate: Pearson correlation that is NULL (not an error) for a constant
    series or a single pair.

    Pairs with a NULL on either side are ignored, as pandas ``Series.corr`` does.
    ``corr`` itself raises DIVIDE_BY_ZERO under ANSI mode for a constant series.
    """
    xx, yy = _c(x), _c(y)
    both = xx.isNotNull() & yy.isNotNull()
    xo = F.when(both, xx.cast("double"))
    yo = F.when(both, yy.cast("double"))
    return F.try_divide(F.covar_pop(xo, yo), F.stddev_pop(xo) * F.stddev_pop(yo))


def corr_band(r: Column | str, threshold: float = 0.3) -> Column:
    """'positive' above ``threshold``, 'negative' below ``-threshold``, else 'weak' (P33)."""
    rr = _c(r)
    return (
        F.when(rr > threshold, F.lit("positive"))
        .when(rr < -threshold, F.lit("negative"))
        .otherwise(F.lit("weak"))
    )


def sign_flag(x: Column | str) -> Column:
    """'up' for a strictly positive value, else 'down'; NULL counts as 0."""
    return F.when(F.coalesce(_c(x), F.lit(0)) > 0, F.lit("up")).otherwise(F.lit("down"))


def pct_change(x: Column | str, order: Column | str) -> Column:
    """``(x / previous x - 1) * 100`` ordered by ``order``; first row NULL.

    Un-partitioned window: use only on frames with a bounded row count (one row per
    year or month), never on fact-sized data.
    """
    w = Window.orderBy(_c(order))
    prev = F.lag(_c(x)).over(w)
    return (F.try_divide(_c(x), prev) - 1) * 100
