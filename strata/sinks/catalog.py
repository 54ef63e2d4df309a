"""Tables by catalog name, replaced as a whole.

``saveAsTable`` in overwrite mode removes the old files before the new ones are written, so a job that dies
half-way leaves nothing.  Here the new contents are written as a table of their own next to the old one, and
only then do names change: until that moment readers see the old table, and a job that
dies leaves it.  Names change in two steps (old aside, new in place); ``recover`` ends or takes
back what a death between them left.  There is no log of transactions: one writer a table is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SchemaMismatchError, same_schema

ASIDE = "__aside"


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop(spark: SparkSession, *names: str) -> None:
    """Drop tables that may or may not be there (staging tables, before and after a run)."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
    if any(c.isPartition for c in spark.catalog.listColumns(new)):
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")  # each partition keeps a location of its own


def recover(spark: SparkSession, name: str) -> None:
    """Put the old table back where a replacement died before the new one had its name."""
    if not exists(spark, name + ASIDE):
        return
    if exists(spark, name):
        drop(spark, name + ASIDE)
    else:
        _rename(spark, name + ASIDE, name)


def _swap(spark: SparkSession, new: str, name: str) -> None:
    if exists(spark, name):
        _rename(spark, name, name + ASIDE)
    _rename(spark, new, name)
    drop(spark, name + ASIDE)


def _refuse_other_columns(df: DataFrame, name: str) -> None:
    if not same_schema(df.sparkSession.table(name).schema, df.schema):
        raise SchemaMismatchError(f"columns of {name} differ from the new data")


def replace(df: DataFrame, name: str, strict: bool = False, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """K01, or K02 with ``strict``: the table ``name`` holds ``df``'s rows from now on.  ``df`` may read the old table."""
    spark = df.sparkSession
    recover(spark, name)
    if strict and exists(spark, name):
        _refuse_other_columns(df, name)
    new = f"{name}__new_{uuid.uuid4().hex[:8]}"
    try:
        w = df.write.format(fmt)
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(new)
    except BaseException:
        drop(spark, new)
        raise
    _swap(spark, new, name)
    return spark.table(name)


def append(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """More rows for ``name`` (made where there is none); other columns or types are refused, nothing is cast."""
    spark = df.sparkSession
    recover(spark, name)
    if exists(spark, name):
        _refuse_other_columns(df, name)
        fmt = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").first()["data_type"]
    df.write.format(fmt).mode("append").saveAsTable(name)
    return spark.table(name)


def create_as(spark: SparkSession, name: str, select: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``CREATE TABLE name AS select``, in place of an older one once the new one is whole."""
    recover(spark, name)
    new = f"{name}__new_{uuid.uuid4().hex[:8]}"
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    try:
        spark.sql(f"CREATE TABLE {new} USING {fmt} {parts} AS {select}")
    except BaseException:
        drop(spark, new)
        raise
    _swap(spark, new, name)
    return spark.table(name)


def database(spark: SparkSession, path: str) -> str:
    """A new database whose tables lie below ``path``; its name."""
    name = f"strata_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name
