"""Demand and supply reductions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance.functions import columns as C
from regional_balance.operators import demand as D
from regional_balance.operators import supply as U
from regional_balance.operators import validate as V
from regional_balance.sources import tabular
from workload.registry import (
    SEGMENTS,
    SQL_ORDERS,
    Tables,
    customer_orders,
    money,
    query,
    rounded,
    wide_demand,
)

SQL_SURVEY = """WITH u AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
v AS (SELECT n_name || '/' || c_mktsegment AS region_id, COUNT(*) AS population, COUNT(o_custkey) AS participants
      FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN u ON o_custkey = c_custkey GROUP BY 1)"""


def survey(t: Tables) -> DataFrame:
    """Customers per nation and segment; those with an urgent order take part."""
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").distinct()
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    people = people.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left")
    region = F.concat_ws("/", "n_name", "c_mktsegment").alias("region_id")
    return people.groupBy(region).agg(F.count("*").alias("population"), F.count("o_custkey").alias("participants"))


@query(
    "demand_from_survey",
    f"{SQL_SURVEY} SELECT region_id, ROUND(COALESCE(CAST(participants AS DOUBLE) / NULLIF(population, 0), 0), 9) AS demand_value FROM v",
)
def demand_from_survey(spark, sf):
    valid = V.clean_survey(survey(Tables(spark, sf))).valid
    return rounded(D.demand_from_survey(valid), demand_value=9)


@query("demand_from_survey_counts", f"{SQL_SURVEY} SELECT region_id, CAST(participants AS DOUBLE) AS demand_value FROM v")
def demand_from_survey_counts(spark, sf):
    return D.demand_from_survey(survey(Tables(spark, sf)), use_rate=False)


@query(
    "demand_from_table",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS region_id, COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS demand_value
FROM events""",
)
def demand_from_table(spark, sf):
    """Numbers that arrive as text inside a JSON column."""
    events = Tables(spark, sf).events
    table = events.select("event_id", F.col("user_id").alias("region_id"), F.get_json_object("props", "$.k").alias("k"))
    return D.demand_from_table(table, "k", by=["event_id"])


@query(
    "demand_from_csv_columns",
    """SELECT o_orderpriority AS region_id, COALESCE(CASE WHEN regexp_matches(v, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?$')
THEN TRY_CAST(v AS DOUBLE) END, 0.0) AS demand_value
FROM (SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN '1e' || SUBSTRING(o_orderpriority, 1, 1)
      ELSE CAST(o_custkey AS VARCHAR) END AS v FROM orders)""",
)
def demand_from_csv_columns(spark, sf):
    """Column roles by header spelling, ids trimmed, unreadable values as zero."""
    orders = Tables(spark, sf).orders
    text = (
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("1e"), F.substring("o_orderpriority", 1, 1)))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    raw = orders.select(F.concat(F.lit(" "), "o_orderpriority", F.lit("\t")).alias(" Region_ID"), text.alias("DEMAND_VALUE "), "o_orderkey")
    return tabular.demand_from_csv(raw)


@query(
    "to_number_coerce",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN o_totalprice ELSE
CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey AS DOUBLE) * 10 WHEN o_orderpriority = '2-HIGH' THEN NULL
WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE -CAST(o_custkey AS DOUBLE) END END AS number FROM orders""",
)
def to_number_coerce(spark, sf):
    """Labels, plain and signed numbers, exponents, blanks, type suffixes and hexadecimal text."""
    key, level = F.col("o_custkey").cast("string"), F.col("o_orderpriority")
    odd = (
        F.when(level == "1-URGENT", F.concat(F.lit(" "), key, F.lit("e1 ")))
        .when(level == "2-HIGH", F.concat(key, F.lit("d")))
        .when(level == "3-MEDIUM", F.concat(F.lit("0x"), key))
        .otherwise(F.concat(F.lit("-"), key))
    )
    text = (
        F.when(F.col("o_orderstatus") == "F", level)
        .when(F.col("o_orderstatus") == "O", F.col("o_totalprice").cast("string"))
        .otherwise(odd)
    )
    return Tables(spark, sf).orders.select("o_orderkey", C.text_number(text).alias("number"))


@query(
    "demand_regions",
    f"WITH {SQL_ORDERS} SELECT DISTINCT n_name AS region_id FROM o",
)
def demand_regions(spark, sf):
    return D.demand_regions(wide_demand(Tables(spark, sf)))


@query(
    "demand_wide_to_long",
    f"""WITH {SQL_ORDERS}, w AS (SELECT COALESCE(n_name, 'GRAND TOTAL') AS region_id, seg AS activity, SUM(v) AS v FROM o GROUP BY GROUPING SETS ((n_name, seg), (seg)))
SELECT r.region_id, a.activity, CAST(COALESCE(v, 0) AS DOUBLE) AS demand FROM (SELECT DISTINCT region_id FROM w) r
CROSS JOIN (SELECT DISTINCT activity FROM w) a LEFT JOIN w ON w.region_id = r.region_id AND w.activity = a.activity""",
)
def demand_wide_to_long(spark, sf):
    return D.demand_long(wide_demand(Tables(spark, sf)), SEGMENTS)


@query(
    "activity_demand_sum",
    f"WITH {SQL_ORDERS} SELECT seg AS activity, CAST(SUM(v) AS DOUBLE) AS demand_value FROM o GROUP BY 1",
)
def activity_demand_sum(spark, sf):
    """The GRAND TOTAL row is left out of the sums."""
    return D.activity_demand(wide_demand(Tables(spark, sf)), SEGMENTS)


@query(
    "activity_demand_mean",
    f"""WITH {SQL_ORDERS} SELECT seg AS activity, ROUND(CAST(SUM(v) AS DOUBLE) / (SELECT COUNT(DISTINCT n_name) FROM o), 4) AS demand_value
FROM o GROUP BY 1""",
)
def activity_demand_mean(spark, sf):
    return rounded(D.activity_demand(wide_demand(Tables(spark, sf)), SEGMENTS, "mean"), demand_value=4)


@query(
    "activity_demand_from_long",
    """SELECT p_brand AS brand, p_type AS activity, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS demand_value
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def activity_demand_from_long(spark, sf):
    """A long table of line items, summed per part before the join, by brand as an extra key."""
    t = Tables(spark, sf)
    lines = t.lineitem.groupBy("l_partkey").agg(F.sum(money("l_extendedprice")).alias("demand"))
    long = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_name").alias("region_id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("activity"), "demand"
    )
    return D.activity_demand_from_long(long, by=["brand"])


@query(
    "scalar_demand_share",
    f"WITH {SQL_ORDERS} SELECT ROUND(CAST(SUM(v) FILTER (WHERE seg = 'MACHINERY') AS DOUBLE) / CAST(SUM(v) AS DOUBLE), 9) AS demand_value FROM o",
)
def scalar_demand_share(spark, sf):
    per_activity = D.activity_demand(wide_demand(Tables(spark, sf)), SEGMENTS)
    return rounded(D.scalar_demand(per_activity, "Machinery", normalize=True, known=SEGMENTS), demand_value=9)


@query("scalar_demand_all", f"WITH {SQL_ORDERS} SELECT ROUND(CAST(SUM(v) AS DOUBLE), 2) AS demand_value FROM o")
def scalar_demand_all(spark, sf):
    return rounded(D.scalar_demand(D.activity_demand(wide_demand(Tables(spark, sf)), SEGMENTS)), demand_value=2)


@query(
    "scalar_demand_share_by_market",
    f"""WITH {SQL_ORDERS} SELECT CAST(n_regionkey AS INTEGER) AS market,
ROUND(CAST(SUM(v) FILTER (WHERE seg = 'MACHINERY') AS DOUBLE) / CAST(SUM(v) AS DOUBLE), 9) AS demand_value FROM o GROUP BY 1""",
)
def scalar_demand_share_by_market(spark, sf):
    rows = customer_orders(Tables(spark, sf)).groupBy(F.col("n_regionkey").alias("market"), F.col("n_name").alias("region_id"))
    wide = rows.agg(*[F.sum(F.when(F.col("segment") == s, F.col("total"))).alias(s) for s in SEGMENTS])
    per_activity = D.activity_demand(wide, SEGMENTS, by=["market"])
    return rounded(D.scalar_demand(per_activity, "MACHINERY", True, ["market"]), demand_value=9)


@query(
    "spread_demand",
    f"""WITH {SQL_ORDERS}, x AS (SELECT CAST(SUM(v) FILTER (WHERE seg = 'MACHINERY') AS DOUBLE) AS d FROM o)
SELECT CAST(c_custkey AS VARCHAR) AS region_id, d AS demand_value FROM customer, x""",
)
def spread_demand(spark, sf):
    """One scalar on every region row, without a join."""
    t = Tables(spark, sf)
    scalar = D.scalar_demand(D.activity_demand(wide_demand(t), SEGMENTS), "MACHINERY")
    return D.spread_demand(t.customer.select(F.col("c_custkey").alias("region_id")), scalar)


@query(
    "ranking_demand",
    f"""WITH {SQL_ORDERS} SELECT n_name AS "Region", CAST(SUM(v) FILTER (WHERE seg = 'AUTOMOBILE') AS DOUBLE) AS "AUTOMOBILE",
CAST(SUM(v) FILTER (WHERE seg = 'BUILDING') AS DOUBLE) AS "BUILDING" FROM o GROUP BY 1""",
)
def ranking_demand(spark, sf):
    """Two of the activities present, region column guessed, keys normalised."""
    wide = wide_demand(Tables(spark, sf), footer=False)
    raw = wide.select(F.concat(F.lit(" "), F.lower("region_id")).alias("place"), "AUTOMOBILE", "BUILDING")
    return tabular.ranking_demand(raw, SEGMENTS)


SQL_FACILITIES = """WITH f AS (SELECT n_name || '/' || c_mktsegment AS region_id, c_name, CASE WHEN c_acctbal > 3000 THEN CAST(c_acctbal AS DECIMAL(18,2))
WHEN c_acctbal < 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) * 5 END AS cap FROM customer JOIN nation ON c_nationkey = n_nationkey),
g AS (SELECT region_id, CAST(SUM(cap) AS DOUBLE) AS cap, COUNT(c_name) AS n FROM f GROUP BY 1)"""


def facilities(t: Tables) -> DataFrame:
    """Customers as facilities of a nation and segment: some capacities missing, some negative."""
    balance = money("c_acctbal")
    capacity = F.when(balance > 3000, balance).when(balance < 0, (balance * 5).cast("decimal(18,2)"))
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.concat_ws("/", "n_name", "c_mktsegment").alias("region_id"), F.col("c_name").alias("facility_id"), capacity.alias("capacity")
    )


@query(
    "supply_from_facilities",
    f"{SQL_FACILITIES} SELECT region_id, CASE WHEN COALESCE(cap, 0) > 0 THEN cap END AS supply_value FROM g",
)
def supply_from_facilities(spark, sf):
    return U.supply_from_facilities(facilities(Tables(spark, sf)))


@query("supply_from_facility_count", f"{SQL_FACILITIES} SELECT region_id, CAST(n AS DOUBLE) AS supply_value FROM g")
def supply_from_facility_count(spark, sf):
    return U.supply_from_facilities(facilities(Tables(spark, sf)), use_capacity=False)


@query(
    "supply_count_fallback",
    f"{SQL_FACILITIES} SELECT region_id, CASE WHEN COALESCE(cap, n) > 0 THEN COALESCE(cap, n) END AS supply_value FROM g",
)
def supply_count_fallback(spark, sf):
    return U.supply_from_facilities(facilities(Tables(spark, sf)), count_fallback=True)


@query("supply_constant", "SELECT DISTINCT c_mktsegment AS region_id, 2.5::DOUBLE AS supply_value FROM customer")
def supply_constant(spark, sf):
    ids = Tables(spark, sf).customer.select(F.col("c_mktsegment").alias("region_id"))
    return U.supply_constant(ids, 2.5, distinct=True)


@query(
    "tabular_supply",
    "SELECT CAST(c_nationkey AS VARCHAR) AS region_id, c_acctbal AS supply_value FROM customer",
)
def tabular_supply(spark, sf):
    """No named supply column: the first numeric column that is not the region column."""
    return U.tabular_supply(Tables(spark, sf).customer.select(F.col("c_nationkey").alias("NAME_2"), "c_name", "c_acctbal"))


@query(
    "supply_keyed",
    """SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN n_name WHEN 'BUILDING' THEN n_name || ' EAST' ELSE CAST(n_nationkey AS VARCHAR) END AS _key,
CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS supply_value
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY') GROUP BY 1""",
)
def supply_keyed(spark, sf):
    """Spellings of a region that must meet: case, blanks, ``7.0``; footers and ``nan`` are dropped."""
    t = Tables(spark, sf)
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    seg = F.col("c_mktsegment")
    label = (
        F.when(seg == "AUTOMOBILE", F.concat(F.lower("n_name"), F.lit(" \t")))
        .when(seg == "BUILDING", F.concat("n_name", F.lit("  \n east")))
        .when(seg == "FURNITURE", F.concat(F.col("n_nationkey").cast("string"), F.lit(".0")))
        .when(seg == "HOUSEHOLD", F.concat(F.lit("SubTotal "), "n_name"))
        .otherwise(F.lit(" NaN "))
    )
    return U.supply_keyed(rows.select(label.alias("region_id"), money("c_acctbal").alias("supply_value")))


@query(
    "merge_key_of_numbers",
    """SELECT p_partkey, CAST(p_size AS VARCHAR) AS from_int, CAST(CAST(p_size AS BIGINT) AS VARCHAR) AS from_double,
CASE WHEN p_retailprice = ROUND(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) ELSE CAST(p_retailprice AS VARCHAR) END AS from_price
FROM part""",
)
def merge_key_of_numbers(spark, sf):
    part = Tables(spark, sf).part.withColumn("as_double", F.col("p_size").cast("double"))
    return part.select(
        "p_partkey",
        C.merge_key(part, "p_size").alias("from_int"),
        C.merge_key(part, "as_double").alias("from_double"),
        C.merge_key(part, "p_retailprice").alias("from_price"),
    )
