"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pytest

from docloom.plans.registry import FLAGSHIP, ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    show = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
    return sorted("|".join(show(r[k]) for k in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    data = [tuple(r) for r in got.collect()]
    if name in ORACLE_SQL:
        want = duck.sql(ORACLE_SQL[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got.columns, data) == rows(want.columns, want.fetchall())


def test_flagship():
    assert FLAGSHIP in QUERIES and FLAGSHIP in ORACLE_SQL


def test_decode_ladder(spark):
    from pyspark.sql import functions as F

    from docloom.operators.blocks import decode

    raw = [("é".encode(),), ("한글".encode("cp949"),), (b"\xef\xbb\xbfx",), ("y".encode("utf-16"),), (b"\xff",), (None,)]
    got = [r[0] for r in spark.createDataFrame(raw, "b binary").select(decode(F.col("b"))).collect()]
    assert got == ["é", "한글", "x", "y", None, None]
