"""Query registry and the inputs that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


class Tables:
    """``tables.orders`` reads orders.parquet of the scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


def money(name: str) -> Column:
    """Two-decimal amounts as decimals: their sums are exact and independent of order."""
    return F.col(name).cast("decimal(18,2)")


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def customer_orders(t: Tables) -> DataFrame:
    """(n_name, n_regionkey, segment, c_custkey, total): orders folded per customer before any join."""
    totals = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total"))
    joined = totals.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("n_name", "n_regionkey", F.col("c_mktsegment").alias("segment"), "c_custkey", "total")


def nation_demand(t: Tables) -> DataFrame:
    return customer_orders(t).groupBy(F.col("n_name").alias("region_id")).agg(F.sum("total").alias("demand_value"))


def nation_facilities(t: Tables) -> DataFrame:
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(
        F.col("s_name").alias("facility_id"), F.col("n_name").alias("region_id"), money("s_acctbal").alias("capacity"), "n_regionkey"
    )


def wide_demand(t: Tables, footer: bool = True) -> DataFrame:
    """(region_id, one column per segment), with a GRAND TOTAL row as hand-made tables have."""
    cells = [F.sum(F.when(F.col("segment") == s, F.col("total"))).alias(s) for s in SEGMENTS]
    rows = customer_orders(t)
    if not footer:
        return rows.groupBy(F.col("n_name").alias("region_id")).agg(*cells)
    folded = rows.rollup("n_name").agg(*cells)
    return folded.select(F.coalesce("n_name", F.lit("GRAND TOTAL")).alias("region_id"), *SEGMENTS)


# Shared SQL
SQL_ORDERS = """
o AS (SELECT n_name, n_regionkey, c_mktsegment AS seg, c_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
SQL_NATION_DEMAND = SQL_ORDERS + """,
d AS (SELECT n_name AS region_id, CAST(SUM(v) AS DOUBLE) AS demand_value FROM o GROUP BY 1)"""
SQL_NATION_SUPPLY = """
s0 AS (SELECT n_name AS region_id, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v
       FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
s AS (SELECT region_id, CASE WHEN v > 0 THEN v END AS supply_value FROM s0)"""


def sql_need(scale: float, low: float, high: float, partition: str = "", extra: str = "") -> str:
    """CTEs j(..., demand_value, supply_value) -> n with score, class and rank."""
    over = f"PARTITION BY {partition} " if partition else ""
    return f"""
sc AS (SELECT *, demand_value / NULLIF(supply_value, 0) * {scale} AS need_score FROM j),
n AS (SELECT *,
  CASE WHEN supply_value IS NULL THEN 'Needs Improvement (No Supply)'
       WHEN need_score < {low} THEN 'Supply Sufficient'
       WHEN need_score <= {high} THEN 'Balanced'
       WHEN need_score > {high} THEN 'Needs Improvement' END AS need_class,
  CASE WHEN need_score IS NOT NULL THEN RANK() OVER ({over}ORDER BY need_score DESC NULLS LAST) END AS priority_rank
  FROM sc)"""
