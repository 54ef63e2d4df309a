"""Tables by catalog name: safe replacement, refusals, recovery, statements of the gold tables, pruned scans."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata.plans import warehouse
from strata.schemas import GOLD_SCHEMAS, SchemaMismatchError, same_schema
from strata.sinks import catalog

from .conftest import SF_SMALL


@pytest.fixture()
def db(spark, tmp):
    name = catalog.database(spark, os.path.join(tmp, "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def ids(spark, name):
    return sorted(r[0] for r in spark.table(name).collect())


def test_a_write_that_dies_leaves_the_old_table(spark, db):
    name = f"{db}.t"
    catalog.replace(spark.range(5), name)
    with pytest.raises(Exception, match="dies"):
        catalog.replace(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error("dies").cast("long")).otherwise(F.col("id")).alias("id")), name)
    assert ids(spark, name) == [0, 1, 2, 3, 4]
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["t"]  # nothing staged is left
    catalog.replace(spark.table(name).filter("id > 2"), name)  # a table may be replaced by what is read from it
    assert ids(spark, name) == [3, 4]


def test_death_between_the_two_names(spark, db):
    name = f"{db}.t"
    catalog.replace(spark.range(3), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}{catalog.ASIDE}")  # the new one did not get its name
    catalog.recover(spark, name)
    assert ids(spark, name) == [0, 1, 2]
    spark.range(7).write.saveAsTable(name + catalog.ASIDE)  # the new one did, the old one was not dropped
    catalog.recover(spark, name)
    assert ids(spark, name) == [0, 1, 2] and not catalog.exists(spark, name + catalog.ASIDE)


def test_strict_writes_and_appends_refuse_other_columns(spark, db):
    name = f"{db}.t"
    catalog.replace(spark.range(3), name, strict=True)
    for other in (spark.range(3).withColumnRenamed("id", "no"), spark.range(3).select(F.col("id").cast("int"))):
        with pytest.raises(SchemaMismatchError):
            catalog.replace(other, name, strict=True)
        with pytest.raises(SchemaMismatchError):
            catalog.append(other, name)
    catalog.append(spark.range(1), name)
    assert ids(spark, name) == [0, 0, 1, 2]
    catalog.append(spark.range(2), f"{db}.u")
    catalog.drop(spark, f"{db}.u", f"{db}.u", name)
    assert all(t.isTemporary for t in spark.catalog.listTables(db))


def test_partitioned_tables_keep_their_partitions(spark, db):
    name = f"{db}.p"
    rows = spark.range(20).selectExpr("id", "id % 4 AS k")
    for _ in range(2):
        catalog.replace(rows, name, partition_by=("k",))
    assert spark.table(name).filter("k = 1").count() == 5 and spark.table(name).count() == 20
    made = catalog.create_as(spark, name, f"SELECT id + 1 AS id, k FROM {name}", partition_by=("k",))
    assert made.agg(F.sum("id")).first()[0] == 210


def test_gold_statements_make_the_declared_columns(spark, db):
    warehouse.build_silver(spark, SF_SMALL, db)
    assert not catalog.exists(spark, f"{db}.staging_trips")
    for name, df in warehouse.build_gold(spark, db).items():
        assert same_schema(df.select(*GOLD_SCHEMAS[name].names).schema, GOLD_SCHEMAS[name]), name
        assert df.count() > 0


def test_the_scan_of_a_partitioned_fact_is_pruned(spark):
    df = warehouse.partitioned_fact(spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "dynamicpruning" in plan.lower()
    rows = df.collect()
    assert rows and {r.month for r in rows} == {4, 5, 6}
