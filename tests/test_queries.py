"""Every registered query against its SQL on the smallest driver tables, and rules all plans keep."""

import math

import pytest

import __spark_entry__ as entry_point
from workload import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, sql, name):
    got = QUERIES[name](spark, sf)
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert normal(got.collect(), got.columns) == normal(cursor.fetchall(), names)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_in_the_jvm_without_cross_joins(spark, sf, plan, name):
    text = plan(QUERIES[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_entry(spark, sf):
    df = entry_point.entry(spark)
    assert df.columns == ["region_id", "demand_value", "supply_value", "need_score", "need_class", "priority_rank"]
    assert df.count() == 25
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
