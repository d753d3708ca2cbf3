"""Contracts, cleaning and label rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance.functions import columns as C
from regional_balance.functions import names as N
from regional_balance.operators import clean as K
from regional_balance.operators import validate as V
from workload.registry import Tables, query


def verdicts(checked: V.Validated, *columns: str) -> DataFrame:
    """Every row with its reasons as one text; valid rows have an empty one."""
    return checked.checked.select(*columns, F.array_join("reasons", "; ").alias("reasons"))


def sql_reasons(*pairs: tuple[str, str]) -> str:
    """Reasons in order, for conditions that mean a rejection."""
    parts = ", ".join(f"CASE WHEN {condition} THEN '{reason}' END" for reason, condition in pairs)
    return f"concat_ws('; ', {parts}) AS reasons"


SQL_USE = """WITH u AS (SELECT p_partkey, p_name, p_size, p_retailprice, COUNT(l_orderkey) AS used FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL)"""


def part_use(t: Tables) -> DataFrame:
    used = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("used"))
    return t.part.join(used, F.col("p_partkey") == F.col("l_partkey"), "left").withColumn("used", F.coalesce("used", F.lit(0)))


@query(
    "validate_survey",
    f"""{SQL_USE} SELECT CAST(p_partkey AS VARCHAR) AS region_id, CASE WHEN p_size < 40 THEN CAST(p_size AS DOUBLE) END AS population,
CAST(used AS DOUBLE) - 20 AS participants, {sql_reasons(
        ("population not a count", "p_size >= 40"),
        ("participants not a count", "used < 20"),
        ("participants exceed population", "p_size < 40 AND used - 20 > p_size"),
    )} FROM u""",
)
def validate_survey(spark, sf):
    """Part sizes as populations (large ones fractional), uses of the part as participants."""
    size = F.when(F.col("p_size") >= 40, F.col("p_size") + 0.5).otherwise(F.col("p_size").cast("double"))
    raw = part_use(Tables(spark, sf)).select(
        F.col("p_partkey").alias("Place Code"), size.alias("Population"), (F.col("used") - 20).alias("participants")
    )
    out = verdicts(V.clean_survey(raw, "place_code"), "region_id", "population", "participants")
    return out.withColumns({c: F.col(c).cast("double") for c in ("population", "participants")})


@query(
    "validate_census",
    f"""SELECT CAST(o_custkey AS VARCHAR) AS region_id,
CASE o_orderstatus WHEN 'F' THEN -CAST(o_custkey AS DOUBLE) - 1 WHEN 'O' THEN CAST(o_custkey AS DOUBLE) END AS total_population,
CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS median_income, CAST(NULL AS DOUBLE) AS poverty_rate,
{sql_reasons(("total_population not a count", "o_orderstatus <> 'O'"), ("median_income not a number", "o_orderpriority = '5-LOW'"))} FROM orders""",
)
def validate_census(spark, sf):
    status = F.col("o_orderstatus")
    total = (
        F.when(status == "F", (-F.col("o_custkey") - 1).cast("string"))
        .when(status == "O", F.col("o_custkey").cast("string"))
        .otherwise(F.lit("unknown"))
    )
    income = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    raw = Tables(spark, sf).orders.select(
        F.col("o_custkey").alias("region_id"), total.alias("Total-Population"), income.alias("Median Income")
    )
    out = verdicts(V.clean_census(raw), "region_id", "total_population", "median_income", "poverty_rate")
    return out.withColumn("total_population", F.col("total_population").cast("double"))


@query(
    "validate_facilities",
    f"""SELECT c_name AS facility_id, CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) END AS region_id, c_mktsegment AS facility_type,
CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS capacity, c_custkey,
{sql_reasons(("capacity not a number", "c_mktsegment = 'BUILDING'"))} FROM customer""",
)
def validate_facilities(spark, sf):
    c = Tables(spark, sf).customer
    raw = c.select(
        "c_custkey",
        F.col("c_name").alias("Facility ID"),
        F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("area"),
        F.col("c_mktsegment").alias("facility-type"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("two pools")).otherwise(F.col("c_acctbal").cast("string")).alias("Capacity"),
    )
    return verdicts(V.clean_facilities(raw, "area"), "facility_id", "region_id", "facility_type", "capacity", "c_custkey")


@query(
    "validate_boundaries",
    f"""SELECT doc_id, CASE WHEN lang <> 'en' THEN source END AS region_id, lang AS name, {sql_reasons(("region_id missing", "lang = 'en'"))} FROM documents""",
)
def validate_boundaries(spark, sf):
    d = Tables(spark, sf).documents
    raw = d.select("doc_id", F.when(F.col("lang") != "en", F.col("source")).alias("NAME_2"), F.col("lang").alias("Name"))
    return verdicts(V.clean_boundaries(raw, "name_2"), "doc_id", "region_id", "name")


@query(
    "validate_demand",
    f"""SELECT UPPER(CASE WHEN c_nationkey = 3 THEN '' ELSE 'r' || c_nationkey END) AS region_id, c_mktsegment AS activity, c_acctbal AS demand,
{sql_reasons(("region_id empty", "c_nationkey = 3"), ("demand negative", "c_acctbal < 0"))} FROM customer""",
)
def validate_demand(spark, sf):
    c = Tables(spark, sf).customer
    region = F.when(F.col("c_nationkey") == 3, F.lit("  ")).otherwise(F.concat(F.lit(" r"), F.col("c_nationkey").cast("string")))
    raw = c.select(region.alias("Region ID"), F.concat("c_mktsegment", F.lit(" ")).alias("Activity"), F.col("c_acctbal").cast("string").alias("Demand"))
    return verdicts(V.clean_demand_long(raw), "region_id", "activity", "demand")


@query(
    "reject_counts",
    """SELECT 'demand negative' AS reason, COUNT(*) AS n FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'activity empty', COUNT(*) FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def reject_counts(spark, sf):
    c = Tables(spark, sf).customer
    activity = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    raw = c.select(F.col("c_name").alias("region_id"), activity.alias("activity"), F.col("c_acctbal").alias("demand"))
    return V.clean_demand_long(raw).reject_counts()


@query(
    "clean_wide",
    """SELECT UPPER(c_name) AS region_id, GREATEST(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_acctbal END, 0) AS "walking/jogging",
CAST(c_custkey AS DOUBLE) AS court_games, c_mktsegment AS note FROM customer""",
)
def clean_wide(spark, sf):
    c = Tables(spark, sf).customer
    value = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("closed")).otherwise(F.col("c_acctbal").cast("string"))
    raw = c.select(
        F.concat(F.lit(" "), "c_name").alias("Region-ID"),
        value.alias(" Walking/Jogging"),
        F.col("c_custkey").alias("Court Games"),
        F.col("c_mktsegment").alias("Note"),
    )
    return K.clean_demand_wide(raw, ["Walking/Jogging", "Court Games"])


@query(
    "clean_wide_unclipped",
    "SELECT UPPER(c_name) AS region_id, c_acctbal AS camping FROM customer",
)
def clean_wide_unclipped(spark, sf):
    raw = Tables(spark, sf).customer.select(F.col("c_name").alias("region_id"), F.col("c_acctbal").alias("Camping"))
    return K.clean_demand_wide(raw, clip_negative=False)


@query(
    "clean_index",
    """SELECT p_name AS region_id, p_type, LEAST(GREATEST(CAST(p_size AS DOUBLE), 1), 10) AS p_size,
LEAST(GREATEST(p_retailprice / 100 - 10, 1), 10) AS swim_index, p_partkey FROM part""",
)
def clean_index(spark, sf):
    """The first column is the region; only the named score columns are clipped."""
    part = Tables(spark, sf).part
    raw = part.select(
        F.concat("p_name", F.lit("  ")).alias("Origin County"), "p_type", "p_size", (F.col("p_retailprice") / 100 - 10).alias("Swim Index"), "p_partkey"
    )
    return K.clean_index(raw, score_columns=["p_size", "swim_index"])


@query(
    "standardize_labels",
    """SELECT p_partkey, lower(regexp_replace(p_name || ' / ' || p_type || '-' || p_brand, '[ \\t/_\\\\-]', '', 'g')) AS label_key,
upper(regexp_replace(p_name || ' ' || p_type, '[ ]+', ' ', 'g')) AS merge_key,
CASE WHEN p_name LIKE 'red%' THEN 'ST. LAWRENCE' ELSE upper(p_name) END AS boundary_id FROM part""",
)
def standardize_labels(spark, sf):
    part = Tables(spark, sf).part
    boundary = F.when(F.col("p_name").startswith("red"), F.lit(" Saint Lawrence")).otherwise(F.col("p_name"))
    return part.select(
        "p_partkey",
        C.label_key(F.concat("p_name", F.lit(" / "), "p_type", F.lit("-"), "p_brand")).alias("label_key"),
        C.text_merge_key(F.concat(F.lit("\n"), "p_name", F.lit(" \t "), "p_type", F.lit(" "))).alias("merge_key"),
        C.boundary_region_id(boundary).alias("boundary_id"),
    )


@query(
    "standardize_columns",
    "SELECT s_suppkey AS supplier_key, s_name AS full_name, s_acctbal AS \"cap/day\" FROM supplier",
)
def standardize_columns(spark, sf):
    s = Tables(spark, sf).supplier
    return N.standardize_columns(s.select(F.col("s_suppkey").alias(" Supplier-Key"), F.col("s_name").alias("FULL NAME "), F.col("s_acctbal").alias("Cap/Day")))


@query(
    "summary_rows",
    """SELECT DISTINCT r_name AS market, p_type AS label FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def summary_rows(spark, sf):
    """Rollup rows labelled as footers are recognised and dropped; detail rows stay."""
    t = Tables(spark, sf)
    lines = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    rows = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    table = rows.rollup("r_name", "p_type").agg(F.sum("n").alias("n"))
    label = F.when(F.col("r_name").isNull(), F.lit(" Grand TOTAL ")).when(F.col("p_type").isNull(), F.concat("r_name", F.lit(" subtotal"))).otherwise(F.col("p_type"))
    labelled = table.select(F.coalesce("r_name", F.lit("ALL")).alias("market"), label.alias("label"))
    return labelled.filter(~C.is_summary_row(F.col("label")))
