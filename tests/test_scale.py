"""Plans under skew: one key holds a third of the rows and nothing is small enough to broadcast."""

from contextlib import contextmanager

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from regional_balance.operators import demand as D
from regional_balance.operators import metrics as M
from regional_balance.operators import score as R
from regional_balance.operators import supply as U
from regional_balance.operators.rank import add_rank
from regional_balance.session import settle, shared_folder
from workload.registry import Tables


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skewed(spark):
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    with settings(spark, **SKEW):
        yield spark


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(c, share=3):
    """A third of the rows take the key ``hot``."""
    return F.when(c % share == 0, F.lit("hot")).otherwise(c.cast("string"))


def test_demand_supply_join_is_split_on_both_sides(skewed, sf):
    t = Tables(skewed, sf)
    # The driver table is spread over several map outputs, as a large table would be; only those can be split.
    demand = t.orders.repartition(8).select(hot(F.col("o_orderkey")).alias("region_id"), F.col("o_totalprice").alias("demand_value"))
    supply = t.part.repartition(8).select(hot(F.col("p_partkey")).alias("region_id"), F.col("p_retailprice").alias("supply_value"))
    text = final_plan(R.combine(demand, supply))
    assert "skew=true" in text
    full = R.combine(demand, supply, keys_unique=True)
    assert "skew=true" not in final_plan(full)
    assert R.combine(demand, supply).exceptAll(full).isEmpty() and full.exceptAll(R.combine(demand, supply)).isEmpty()


def test_rank_with_a_hot_score_and_hot_missing_scores(skewed, sf):
    rows = Tables(skewed, sf).lineitem.repartition(8)
    kind = F.xxhash64("l_orderkey", "l_partkey", "l_suppkey") % 3
    score = F.when(kind == 0, F.lit(500.0)).when(kind == 1, F.col("l_extendedprice"))
    rows = rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", score.alias("need_score"))
    ranked = add_rank(rows)
    assert "skew=true" in final_plan(ranked)
    w = Window.orderBy(F.col("need_score").desc_nulls_last())
    want = rows.withColumn("priority_rank", F.when(F.col("need_score").isNotNull(), F.rank().over(w)).cast("long"))
    assert ranked.exceptAll(want).isEmpty() and want.exceptAll(ranked).isEmpty()


def test_aggregates_combine_before_the_shuffle(spark, sf, plan):
    t = Tables(spark, sf)
    lines = t.lineitem.select(F.col("l_returnflag").alias("region_id"), F.col("l_orderkey").alias("facility_id"), F.col("l_quantity").alias("capacity"))
    supply = plan(U.supply_from_facilities(lines))
    assert "partial_sum" in supply and "facility_id" not in supply.replace("l_orderkey", "")
    wide = lines.withColumn("Park", F.col("capacity")).withColumn("Camping", F.col("capacity"))
    demand = plan(D.activity_demand(wide))
    assert demand.count("partial_sum") >= 2
    assert demand.index("Expand") < demand.index("Exchange")  # printed top down: the melt comes after the aggregate


def test_one_scan_of_supply_for_all_activities(spark, sf, plan):
    t = Tables(spark, sf)
    supply = t.supplier.select(F.col("s_name").alias("region"), F.col("s_acctbal").alias("capacity"))
    per = spark.createDataFrame([("Park", 1.0), ("Camping", 2.0)], "activity string, demand_value double")
    text = plan(M.activity_metrics(per, U.activity_supply(supply), activities=["Park", "Camping"]))
    assert text.count("FileScan parquet") == 1 and "BroadcastHashJoin" in text
    # Supply rows cross one exchange, keyed by region, and none keyed by the few activities.
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark, sf, plan):
    t = Tables(spark, sf)
    survey = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_name").alias("region_id"), F.col("c_acctbal").alias("participants"))
    text = plan(D.demand_from_survey(survey))
    assert "GreaterThan(c_acctbal,0.0)" in text and "c_mktsegment" not in text


def test_settle_keeps_rows_and_uses_the_shared_folder(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    kept = settle(df)
    assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()
    assert kept.collect() == df.collect()
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_scores_from_floating_sums_are_computed_once(spark, sf, plan):
    t = Tables(spark, sf)
    demand = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("region_id")).agg(F.sum("l_extendedprice").alias("demand_value"))
    supply = t.supplier.select(F.col("s_suppkey").cast("string").alias("region_id"), F.col("s_acctbal").alias("supply_value"))
    table = R.need_table(demand, supply)
    assert "FileScan" not in plan(table)
    ranked = table.filter("need_score is not null")
    assert ranked.filter("priority_rank is null").isEmpty() and ranked.count() > 0
