"""Catalog-style access to parquet tables (S10) and SQL over registered views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(root: str, name: str) -> str:
    """``<root>/<name>.parquet`` when that file/folder exists, else ``<root>/<name>``."""
    p = os.path.join(root, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in root else os.path.join(root, name)


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one table lazily; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(root, name))


def register_views(spark: SparkSession, root: str, names: list[str]) -> None:
    """Expose tables as temp views so reports can be written in SQL."""
    for n in names:
        load(spark, root, n).createOrReplaceTempView(n)
