"""Need scores, ranks, lists and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance import score_regions
from regional_balance.functions import columns as C
from regional_balance.operators import demand as D
from regional_balance.operators import metrics as M
from regional_balance.operators import score as R
from regional_balance.operators import supply as U
from regional_balance.operators.rank import add_rank
from regional_balance.plans.ranking import activity_ranking
from regional_balance.schema import ScoreParams
from workload.registry import (
    SEGMENTS,
    SQL_NATION_DEMAND,
    SQL_NATION_SUPPLY,
    SQL_ORDERS,
    Tables,
    customer_orders,
    money,
    nation_demand,
    nation_facilities,
    query,
    rounded,
    sql_need,
    wide_demand,
)

NATION = ScoreParams(scale=1.0, low=5000.0, high=10000.0)
SQL_NATION = f"""WITH {SQL_NATION_DEMAND}, {SQL_NATION_SUPPLY},
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(1.0, 5000, 10000)}"""
NEED_COLUMNS = """region_id, ROUND(demand_value, 2) AS demand_value, ROUND(supply_value, 2) AS supply_value,
ROUND(need_score, 6) AS need_score, need_class, CAST(priority_rank AS DOUBLE) AS priority_rank"""


def nation_table(t: Tables) -> DataFrame:
    supply = U.supply_from_facilities(nation_facilities(t))
    return R.need_table(nation_demand(t), supply, params=NATION, keys_unique=True, reproducible=True)


def tidy(df: DataFrame) -> DataFrame:
    """Rounded for comparison; ranks as doubles, the form a missing rank has in tabular files."""
    df = df.withColumn("priority_rank", F.col("priority_rank").cast("double"))
    return rounded(df, demand_value=2, supply_value=2, need_score=6)


@query("need_score_by_nation", f"{SQL_NATION} SELECT {NEED_COLUMNS} FROM n")
def need_score_by_nation(spark, sf):
    return tidy(nation_table(Tables(spark, sf)))


@query(
    "improvement_list",
    f"""{SQL_NATION} SELECT {NEED_COLUMNS} FROM n
WHERE COALESCE(need_score > 8000, FALSE) OR COALESCE(need_class LIKE '%Needs Improvement%', FALSE)""",
)
def improvement_list(spark, sf):
    return tidy(R.improvement_list(nation_table(Tables(spark, sf)), threshold=8000))


SQL_CUSTOMER = f"""WITH
d AS (SELECT CAST(user_id AS VARCHAR) AS region_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS demand_value
      FROM events GROUP BY 1),
s AS (SELECT CAST(c_custkey AS VARCHAR) AS region_id, CASE WHEN SUM(CAST(c_acctbal AS DECIMAL(18,2))) > 0
      THEN CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) END AS supply_value FROM customer GROUP BY 1),
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(1.0, 0.5, 1.0)}"""


def customer_table(t: Tables) -> DataFrame:
    """Event value as demand of customers, account balance as their supply: neither side covers the other."""
    demand = t.events.groupBy(F.col("user_id").cast("string").alias("region_id")).agg(
        F.sum(money("value")).alias("demand_value")
    )
    accounts = t.customer.select(
        F.col("c_custkey").cast("string").alias("region_id"), F.col("c_name").alias("facility_id"), money("c_acctbal").alias("capacity")
    )
    supply = U.supply_from_facilities(accounts)
    return R.need_table(demand, supply, params=ScoreParams(scale=1.0), keys_unique=True, reproducible=True)


@query("need_score_by_customer", f"{SQL_CUSTOMER} SELECT {NEED_COLUMNS} FROM n")
def need_score_by_customer(spark, sf):
    return tidy(customer_table(Tables(spark, sf)))


@query(
    "need_score_by_document",
    f"""WITH
j AS (SELECT CAST(COALESCE(d.doc_id, l.doc_id) AS VARCHAR) AS region_id, COALESCE(CAST(n_chars AS DOUBLE), 0.0) AS demand_value,
             CAST(quality AS DOUBLE) AS supply_value
      FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id),
{sql_need(0.001, 0.5, 1.0)} SELECT {NEED_COLUMNS} FROM n""",
)
def need_score_by_document(spark, sf):
    """Label quality 0 is a supply of zero (no score, no class); an unlabelled document has no supply."""
    t = Tables(spark, sf)
    demand = D.demand_from_table(t.documents.select(F.col("doc_id").alias("region_id"), "n_chars"), "n_chars")
    supply = U.tabular_supply(t.labels.select(F.col("doc_id").alias("county"), F.col("quality").alias("capacity")))
    return tidy(R.need_table(demand, supply, params=ScoreParams(scale=0.001), reproducible=True))


@query(
    "need_score_repeated_supply",
    f"""WITH {SQL_NATION_DEMAND},
s AS (SELECT n_name AS region_id, s_acctbal AS supply_value FROM supplier JOIN nation ON s_nationkey = n_nationkey),
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(1.0, 5000, 10000)} SELECT {NEED_COLUMNS} FROM n""",
)
def need_score_repeated_supply(spark, sf):
    """Supply rows are not added up: each gets its own score, negative supply a negative one."""
    t = Tables(spark, sf)
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("region"), F.col("s_acctbal").alias("total_supply")
    )
    return tidy(R.need_table(nation_demand(t), U.tabular_supply(rows), params=NATION, reproducible=True))


@query(
    "need_score_summed_supply",
    f"""WITH {SQL_NATION_DEMAND},
s AS (SELECT n_name AS region_id, CASE WHEN SUM(CAST(s_acctbal AS DECIMAL(18,2))) > 0
      THEN CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) END AS supply_value
      FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(1.0, 5000, 10000)} SELECT {NEED_COLUMNS} FROM n""",
)
def need_score_summed_supply(spark, sf):
    t = Tables(spark, sf)
    rows = nation_facilities(t).select("region_id", F.col("capacity").alias("supply_value"))
    table = R.need_table(
        nation_demand(t), rows, params=NATION, dedupe_supply="sum", nonpositive_supply="null", reproducible=True
    )
    return tidy(table)


@query(
    "need_score_by_market",
    f"""WITH {SQL_ORDERS},
d AS (SELECT r_name AS market, n_name AS region_id, CAST(SUM(v) AS DOUBLE) AS demand_value
      FROM o JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
s0 AS (SELECT r_name AS market, n_name AS region_id, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
s AS (SELECT market, region_id, CASE WHEN v > 0 THEN v END AS supply_value FROM s0),
j AS (SELECT market, region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (market, region_id)),
{sql_need(1.0, 5000, 10000, partition="market")} SELECT market, {NEED_COLUMNS} FROM n""",
)
def need_score_by_market(spark, sf):
    """Many region layers scored in one job: ranks start anew in every market."""
    t = Tables(spark, sf)
    markets = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("market"))
    demand = customer_orders(t).groupBy("n_regionkey", F.col("n_name").alias("region_id")).agg(F.sum("total").alias("demand_value"))
    demand = demand.join(markets, "n_regionkey")
    facilities = nation_facilities(t).join(markets, "n_regionkey")
    supply = U.supply_from_facilities(facilities, by=["market"])
    return tidy(R.need_table(demand, supply, ["market"], NATION, keys_unique=True, reproducible=True))


@query(
    "need_rank_by_priority",
    """SELECT o_orderkey, o_orderpriority, o_totalprice AS need_score,
RANK() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS LAST) AS priority_rank FROM orders""",
)
def need_rank_by_priority(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", F.col("o_totalprice").alias("need_score"))
    return add_rank(orders, by=["o_orderpriority"])


@query(
    "need_rank_global_lineitem",
    """WITH q AS (SELECT l_suppkey, l_partkey, NULLIF(CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE), 25.0) AS need_score
FROM lineitem GROUP BY 1, 2)
SELECT *, CAST(CASE WHEN need_score IS NOT NULL THEN RANK() OVER (ORDER BY need_score DESC NULLS LAST) END AS DOUBLE) AS priority_rank FROM q""",
)
def need_rank_global_lineitem(spark, sf):
    """Heavy ties and missing scores."""
    pairs = Tables(spark, sf).lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("q"))
    ranked = add_rank(pairs.select("l_suppkey", "l_partkey", F.nullif(F.col("q"), F.lit(25.0)).alias("need_score")))
    return ranked.withColumn("priority_rank", F.col("priority_rank").cast("double"))


SQL_ACTIVITY = f"""WITH {SQL_ORDERS},
a AS (SELECT seg AS activity, CAST(SUM(v) AS DOUBLE) AS demand_value FROM o GROUP BY 1),
sup AS (SELECT n_name AS region_id, CAST(s_acctbal AS DECIMAL(18,2)) AS b, s_suppkey AS k
        FROM supplier JOIN nation ON s_nationkey = n_nationkey),
tot AS (SELECT region_id, CAST(SUM(b) AS DOUBLE) AS total, CAST(SUM(k) AS DOUBLE) AS keys FROM sup GROUP BY 1),
l AS (SELECT region_id, activity, CASE activity WHEN 'BUILDING' THEN keys ELSE total END AS supply_value
      FROM tot, (SELECT DISTINCT activity FROM a))"""


def supply_columns(t: Tables) -> DataFrame:
    """Tabular supply with one activity column and a total column for the others."""
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.lower("n_name").alias(" County "), F.col("s_suppkey").alias("Buil-ding"), money("s_acctbal").alias("finalCap"))


@query("activity_supply", f"{SQL_ACTIVITY} SELECT region_id, activity, ROUND(supply_value, 2) AS supply_value FROM l")
def activity_supply(spark, sf):
    return rounded(U.activity_supply(supply_columns(Tables(spark, sf)), SEGMENTS), supply_value=2)


@query(
    "activity_supply_from_sheets",
    f"""{SQL_ACTIVITY} SELECT region_id, activity, ROUND(supply_value, 2) AS supply_value FROM l WHERE activity <> 'FURNITURE'
UNION ALL SELECT n_name, 'FURNITURE', ROUND(CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), 2)
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def activity_supply_from_sheets(spark, sf):
    """The first sheet serves one activity only; the others come from the second sheet."""
    t = Tables(spark, sf)
    first = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("Region"), money("c_acctbal").alias("Furniture"), F.col("c_name").alias("note")
    )
    first = first.withColumn("Furniture", F.col("Furniture").cast("string"))
    return rounded(U.activity_supply_from_sheets([first, supply_columns(t)], SEGMENTS), supply_value=2)


def _activity_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    return D.activity_demand(wide_demand(t), SEGMENTS), U.activity_supply(supply_columns(t), SEGMENTS)


@query(
    "activity_metrics_long",
    f"""{SQL_ACTIVITY} SELECT region_id, activity, ROUND(demand_value, 2) AS demand_value, ROUND(supply_value, 2) AS supply_value,
ROUND(demand_value - supply_value, 2) AS gap, ROUND(CASE WHEN demand_value > 0 THEN supply_value / demand_value END, 9) AS supply_demand_ratio,
ROUND(demand_value / NULLIF(supply_value, 0) * 100, 4) AS need_score FROM l JOIN a USING (activity)""",
)
def activity_metrics_long(spark, sf):
    out = M.activity_metrics(*_activity_inputs(Tables(spark, sf)), activities=SEGMENTS)
    return rounded(out, demand_value=2, supply_value=2, gap=2, supply_demand_ratio=9, need_score=4)


@query(
    "activity_metrics_by_market",
    f"""WITH {SQL_ORDERS},
a AS (SELECT r_name AS market, seg AS activity, CAST(SUM(v) AS DOUBLE) AS demand_value
      FROM o JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
l AS (SELECT r_name AS market, n_name AS region_id, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS supply_value
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
SELECT market, region_id, activity, ROUND(demand_value - supply_value, 2) AS gap,
ROUND(demand_value / NULLIF(supply_value, 0) * 100, 4) AS need_score FROM l JOIN a USING (market)""",
)
def activity_metrics_by_market(spark, sf):
    t = Tables(spark, sf)
    markets = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("market"))
    wide = customer_orders(t).join(markets, "n_regionkey").groupBy("market", F.col("n_name").alias("region_id"))
    wide = wide.agg(*[F.sum(F.when(F.col("segment") == s, F.col("total"))).alias(s) for s in SEGMENTS])
    supply = nation_facilities(t).join(markets, "n_regionkey").select("market", "region_id", "capacity")
    out = M.activity_metrics(
        D.activity_demand(wide, SEGMENTS, by=["market"]), U.activity_supply(supply, SEGMENTS, ["market"]), ["market"], activities=SEGMENTS
    )
    return rounded(out.select("market", "region_id", "activity", "gap", "need_score"), gap=2, need_score=4)


SQL_ACTIVITY_SCORES = f"""{SQL_ACTIVITY},
x AS (SELECT activity, region_id AS "Region", demand_value AS activity_demand,
      demand_value / NULLIF(supply_value, 0) * 100 AS "ActivityNeedScore" FROM l JOIN a USING (activity))"""


@query(
    "activity_scores",
    f"""{SQL_ACTIVITY_SCORES} SELECT activity, "Region", ROUND(activity_demand, 2) AS activity_demand,
ROUND("ActivityNeedScore", 4) AS "ActivityNeedScore" FROM x""",
)
def activity_scores(spark, sf):
    return rounded(M.activity_scores(*_activity_inputs(Tables(spark, sf)), activities=SEGMENTS), activity_demand=2, ActivityNeedScore=4)


@query(
    "activity_scores_one",
    f"""{SQL_ACTIVITY_SCORES} SELECT "Region", ROUND(activity_demand, 2) AS activity_demand,
ROUND("ActivityNeedScore", 4) AS "ActivityNeedScore" FROM x WHERE activity = 'BUILDING'""",
)
def activity_scores_one(spark, sf):
    out = M.activity_scores(*_activity_inputs(Tables(spark, sf)), activity="BUILDING").drop("activity")
    return rounded(out, activity_demand=2, ActivityNeedScore=4)


@query(
    "activity_topk",
    f"""{SQL_ACTIVITY_SCORES}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY activity ORDER BY "ActivityNeedScore" DESC NULLS LAST, "Region") AS place FROM x)
SELECT activity, "Region", ROUND("ActivityNeedScore", 4) AS "ActivityNeedScore", place FROM r WHERE place <= 5""",
)
def activity_topk(spark, sf):
    scores = M.activity_scores(*_activity_inputs(Tables(spark, sf)), activities=SEGMENTS).drop("activity_demand")
    top = R.top_regions(scores, 5, True, "ActivityNeedScore", "Region", ["activity"])
    return rounded(top.withColumn("place", F.col("place").cast("long")), ActivityNeedScore=4)


@query(
    "ranking_stats",
    f"""{SQL_ACTIVITY_SCORES} SELECT activity, COUNT(*) AS supply_rows, COUNT(*) AS matched_rows, COUNT("ActivityNeedScore") AS scored_rows FROM x GROUP BY 1""",
)
def ranking_stats(spark, sf):
    scores = M.activity_scores(*_activity_inputs(Tables(spark, sf)), activities=SEGMENTS)
    return M.row_stats(scores, by=["activity"])


@query(
    "activity_ranking",
    f"""{SQL_ACTIVITY_SCORES} SELECT "Region", ROUND("ActivityNeedScore", 4) AS "ActivityNeedScore" FROM x WHERE activity = 'MACHINERY'
ORDER BY x."ActivityNeedScore" DESC NULLS LAST, "Region" LIMIT 10""",
)
def ranking(spark, sf):
    """The ranking list of one activity, from a wide demand table and a tabular supply."""
    t = Tables(spark, sf)
    rows = activity_ranking(wide_demand(t), supply_columns(t), "MACHINERY", limit=10).rows
    return rounded(rows.select("Region", "ActivityNeedScore"), ActivityNeedScore=4)


@query(
    "lowest_scores",
    f"""{SQL_CUSTOMER} SELECT {NEED_COLUMNS} FROM n ORDER BY n.need_score ASC NULLS LAST, region_id LIMIT 25""",
)
def lowest_scores(spark, sf):
    """Ascending list: missing scores are last in this direction too."""
    return tidy(R.top_regions(customer_table(Tables(spark, sf)), 25, descending=False))


@query(
    "activity_display",
    f"""{SQL_ACTIVITY_SCORES} SELECT activity, SUBSTRING("Region", 1, 20) AS region_text,
COALESCE(printf('%.3f', "ActivityNeedScore"), '-') AS score_text, COALESCE(printf('%.6f', "ActivityNeedScore"), '—') AS tooltip_text FROM x""",
)
def activity_display(spark, sf):
    shown = M.display_rows(M.activity_scores(*_activity_inputs(Tables(spark, sf)), activities=SEGMENTS))
    return shown.select("activity", "region_text", "score_text", "tooltip_text")


@query(
    "summary_stats",
    f"""{SQL_CUSTOMER} SELECT COUNT(DISTINCT region_id) AS total_regions,
COUNT(*) FILTER (WHERE need_class LIKE '%Needs Improvement%') AS needs_improvement_count,
ROUND(AVG(need_score), 6) AS avg_need_score, ROUND(MAX(need_score), 6) AS max_need_score,
(SELECT region_id FROM n ORDER BY need_score DESC NULLS LAST, region_id LIMIT 1) AS highest_need_region FROM n""",
)
def summary_stats(spark, sf):
    return rounded(M.summary(customer_table(Tables(spark, sf))), avg_need_score=6, max_need_score=6)


@query(
    "summary_by_class",
    f"""{SQL_CUSTOMER} SELECT need_class, COUNT(DISTINCT region_id) AS total_regions, ROUND(AVG(need_score), 6) AS avg_need_score,
ROUND(MAX(need_score), 6) AS max_need_score FROM n GROUP BY 1""",
)
def summary_by_class(spark, sf):
    out = M.summary(customer_table(Tables(spark, sf)).withColumn("k", F.col("need_class")), by=["k"])
    out = out.select(F.col("k").alias("need_class"), "total_regions", "avg_need_score", "max_need_score")
    return rounded(out, avg_need_score=6, max_need_score=6)


SQL_EDGES = """lim AS (SELECT MIN(need_score) AS lo, MAX(need_score) AS hi FROM n)"""


@query(
    "class_breaks",
    f"""{SQL_CUSTOMER}, {SQL_EDGES}
SELECT i AS edge, ROUND(lo + i * (hi - lo) / 5, 6) AS score FROM lim, (SELECT UNNEST([0, 1, 2, 3, 4, 5]) AS i)""",
)
def class_breaks(spark, sf):
    edges = M.class_breaks(customer_table(Tables(spark, sf)))
    return edges.select(F.posexplode("edges").alias("edge", "v")).select("edge", F.round("v", 6).alias("score"))


@query(
    "class_bins",
    f"""{SQL_CUSTOMER}, {SQL_EDGES}
SELECT region_id, CAST(CASE WHEN need_score IS NOT NULL THEN 1 + CAST(need_score >= lo + (hi - lo) / 5 AS INTEGER)
+ CAST(need_score >= lo + 2 * ((hi - lo) / 5) AS INTEGER) + CAST(need_score >= lo + 3 * ((hi - lo) / 5) AS INTEGER)
+ CAST(need_score >= lo + 4 * ((hi - lo) / 5) AS INTEGER) END AS DOUBLE) AS score_bin FROM n, lim""",
)
def class_bins(spark, sf):
    return M.with_class_bin(customer_table(Tables(spark, sf))).select(
        "region_id", F.col("score_bin").cast("double").alias("score_bin")
    )


@query("score_sentinel", f"{SQL_CUSTOMER} SELECT region_id, ROUND(COALESCE(need_score, -1), 6) AS shown FROM n")
def score_sentinel(spark, sf):
    shown = C.score_or_sentinel(F.col("need_score"))
    return customer_table(Tables(spark, sf)).select("region_id", F.round(shown, 6).alias("shown"))


@query(
    "dedupe_last",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def dedupe_last(spark, sf):
    orders = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return R.keep_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


SQL_RUN = f"""WITH {SQL_ORDERS},
tot AS (SELECT SUM(v) AS t, SUM(v) FILTER (WHERE seg = 'BUILDING') AS b FROM o),
s AS (SELECT n_name AS region_id, SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""


@query(
    "score_run_workbook",
    f"""{SQL_RUN},
j AS (SELECT region_id, CAST(b AS DOUBLE) / CAST(t AS DOUBLE) AS demand_value, CAST(v AS DOUBLE) AS supply_value FROM s, tot),
{sql_need(100000000.0, 50.0, 60.0)} SELECT region_id, ROUND(demand_value, 9) AS demand_value, ROUND(supply_value, 2) AS supply_value,
ROUND(need_score, 4) AS need_score, need_class, priority_rank FROM n""",
)
def score_run_workbook(spark, sf):
    """The batch run on a wide demand table: one activity's share of demand on every supply region."""
    t = Tables(spark, sf)
    supply = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("county"))
    supply = supply.agg(F.sum(money("c_acctbal")).alias("capacity"))
    run = score_regions(
        wide_demand(t), supply, activity="building", activities=SEGMENTS, params=ScoreParams(100000000.0, 50.0, 60.0)
    )
    return rounded(run.need_table, demand_value=9, supply_value=2, need_score=4)


@query(
    "score_run_metrics",
    f"""{SQL_RUN}, a AS (SELECT seg AS activity, CAST(SUM(v) AS DOUBLE) AS d FROM o GROUP BY 1)
SELECT region_id, activity, ROUND(d - CAST(s.v AS DOUBLE), 2) AS gap, ROUND(d / NULLIF(CAST(s.v AS DOUBLE), 0) * 100, 4) AS need_score FROM s, a""",
)
def score_run_metrics(spark, sf):
    t = Tables(spark, sf)
    supply = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("county"))
    supply = supply.agg(F.sum(money("c_acctbal")).alias("capacity"))
    run = score_regions(wide_demand(t), supply, activities=SEGMENTS)
    return rounded(run.activity_metrics.select("region_id", "activity", "gap", "need_score"), gap=2, need_score=4)


@query(
    "score_run_constant_supply",
    f"""WITH {SQL_ORDERS}, j AS (SELECT DISTINCT n_name AS region_id, 1.0::DOUBLE AS demand_value, 1.0::DOUBLE AS supply_value FROM o),
{sql_need(100.0, 0.5, 1.0)} SELECT {NEED_COLUMNS} FROM n""",
)
def score_run_constant_supply(spark, sf):
    return tidy(score_regions(wide_demand(Tables(spark, sf)), activities=SEGMENTS).need_table)


@query(
    "score_run_table",
    f"""WITH {SQL_NATION_DEMAND}, {SQL_NATION_SUPPLY},
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(100.0, 0.5, 1.0)} SELECT {NEED_COLUMNS} FROM n WHERE need_score > 1000000 OR need_class LIKE '%Needs Improvement%'""",
)
def score_run_table(spark, sf):
    """Demand matched to supply by region; the improvement list of the run."""
    t = Tables(spark, sf)
    run = score_regions(nation_demand(t), U.supply_from_facilities(nation_facilities(t)), threshold=1000000)
    return tidy(run.improvement)
