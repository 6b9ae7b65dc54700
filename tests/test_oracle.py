"""Every registered query against its SQL oracle in DuckDB, at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(E._weather_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert name in ORACLE
    res = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), res.columns)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "value"]
    assert df.count() >= 0


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E._weather_queries()))
def test_query_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel = con.sql(ORACLE[name])
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
