"""Table writers.

Tables are folders of files addressed by path (or catalog names, when a
metastore is configured).  Delta's schema rules are reproduced on plain
parquet: ``overwrite`` may change the schema only when asked, ``append`` and
strict overwrite refuse a different schema.  The format is an option, so a
cluster with the Delta package can pass ``fmt="delta"``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SchemaMismatchError, same_schema


def _exists(spark: SparkSession, path: str, fmt: str) -> bool:
    """Whether there is a table: only a missing or empty location says no, any other error is raised."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target) or not len(fs.listStatus(target)):
        return False
    spark.read.format(fmt).load(path).schema  # noqa: B018 - an unreadable table must not be replaced
    return True


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", allow_schema_change: bool = True, partition_by: list[str] | None = None) -> None:
    """K01 (``allow_schema_change``) / K02 (strict): replace the table's contents."""
    spark = df.sparkSession
    if not allow_schema_change and _exists(spark, path, fmt):
        old = spark.read.format(fmt).load(path).schema
        if not same_schema(old, df.schema):
            raise SchemaMismatchError(f"schema of {path} differs from the new data")
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows; refuse data whose schema differs from the existing table."""
    spark = df.sparkSession
    if _exists(spark, path, fmt):
        old = spark.read.format(fmt).load(path).schema
        if not same_schema(old, df.schema):
            raise SchemaMismatchError(f"schema of {path} differs from the appended data")
    df.write.mode("append").format(fmt).save(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a catalog table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_mapped(df: DataFrame, path: str, mapping: dict[str, str], fmt: str = "parquet") -> None:
    """Keep and rename columns by a source -> destination mapping, then replace."""
    overwrite(df.select(*[F.col(s).alias(d) for s, d in mapping.items()]), path, fmt)


def create_table_as(spark: SparkSession, name: str, select_sql: str, fmt: str = "parquet", location: str | None = None) -> DataFrame:
    """``CREATE TABLE name USING fmt [LOCATION path] AS SELECT ...`` (replaces it).

    The select is planned before the old table goes, and without a location the new table is complete before.
    """
    spark.sql(select_sql).schema  # noqa: B018 - a select that cannot be planned leaves the old table
    if location:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{location}' AS {select_sql}")
        return spark.table(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}__new")
    spark.sql(f"CREATE TABLE {name}__new USING {fmt} AS {select_sql}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {name}__new RENAME TO {name}")
    return spark.table(name)


def write_if_any(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write only when there is at least one row; report whether it wrote.

    The emptiness test reads at most one row (``isEmpty`` is a limit-1 job).
    """
    if df.isEmpty():
        return False
    overwrite(df, path, fmt)
    return True


def write_and_reload(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Materialise ``df`` and continue from the written table: this cuts the
    lineage, so a lost executor re-reads files instead of recomputing the plan."""
    overwrite(df, path, fmt)
    return df.sparkSession.read.format(fmt).load(path)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", allow_schema_change: bool = True) -> tuple[DataFrame, int]:
    """Write ``df`` and return (the written table, its row count).

    The count is an observed metric of the write job itself (A24), so the data
    is evaluated once instead of once for ``count()`` and again for the write.
    """
    from pyspark.sql import Observation

    obs = Observation("rows_written")
    overwrite(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, fmt, allow_schema_change)
    return df.sparkSession.read.format(fmt).load(path), int(obs.get["rows"])
