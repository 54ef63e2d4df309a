"""Equi-joins to dimensions and between aggregated frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def join_dimension(left: DataFrame, dim: DataFrame, on: Column | str | list[str], how: str = "left") -> DataFrame:
    """Join ``left`` to a dimension-like frame.

    No side is hinted: Catalyst's size estimate and AQE's measured sizes choose, a broadcast
    below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and a sort-merge join with skew
    splitting otherwise.
    """
    return left.join(dim, on, how)
