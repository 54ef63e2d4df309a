"""Every registered query against its DuckDB SQL on the sf0.001 tables: same
columns, same row count, same multiset of values (exact)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, canon

from .conftest import SF_SMALL

from strata.plans.registry import QUERIES as OWN

# the optional operators have tests of their own
QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
# Spark type -> DuckDB type name, for the column-type part of the comparison
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[key])
    dtypes = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    stypes = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == dtypes
    cur = con.execute(SQL[key])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(srows, df.columns) == canon(drows, dcols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10 and df.columns == ["pickup_zone_id", "zone_name", "borough", "trip_count"]
