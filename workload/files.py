"""File discovery, sheet layouts, features and stored results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance import score_regions
from regional_balance.functions import columns as C
from regional_balance.functions import geometry as G
from regional_balance.operators import layout as L
from regional_balance.operators import supply as U
from regional_balance.schema import ACTIVITIES
from regional_balance.session import shared_folder
from regional_balance.sinks import writers
from regional_balance.sources import discovery, features, results
from workload.registry import SQL_NATION_DEMAND, SQL_NATION_SUPPLY, Tables, nation_demand, nation_facilities, query, sql_need
from workload.scores import NEED_COLUMNS, tidy

SQL_LISTING = """WITH f AS (SELECT doc_id, lang || '/' || source || '/' || CASE WHEN n_chars % 11 = 0 THEN '~$' ELSE '' END || 's' || n_chars || '_' ||
CASE lang WHEN 'fr' THEN 'Facilities' WHEN 'de' THEN 'M4' ELSE '' END || lower(to_hex(doc_id)) ||
CASE WHEN n_chars % 5 = 0 THEN '.geojson' WHEN n_chars % 5 = 1 THEN '.XLSX' WHEN n_chars % 5 = 2 THEN '.txt' ELSE '.csv' END AS path,
to_timestamp(n_chars * 1000) AS m FROM documents),
r AS (SELECT *, string_split(path, '/')[-1] AS name FROM f),
h AS (SELECT *, contains(lower(name), 'd8') OR contains(lower(name), 'demand') OR starts_with(lower(name), 'm4') AS d,
contains(lower(name), 's12') OR contains(lower(name), 'supply') OR contains(lower(name), 'facilit') AS s FROM r),
c AS (SELECT *, CASE WHEN starts_with(name, '~$') THEN NULL WHEN d AND NOT s THEN 'demand' WHEN s AND NOT d THEN 'supply' END AS role,
regexp_extract(lower(name), '[.][a-z]+$') AS ext FROM h),
k AS (SELECT * FROM c WHERE (role = 'demand' AND ext IN ('.xlsx', '.xls', '.csv'))
OR (role = 'supply' AND ext IN ('.xlsx', '.xls', '.csv', '.geojson', '.json', '.gpkg', '.shp')))"""


def listing(t: Tables) -> DataFrame:
    """A file listing with names made from document ids and lengths: markers, extensions and lock files occur by chance."""
    n = F.col("n_chars")
    ext = (
        F.when(n % 5 == 0, ".geojson").when(n % 5 == 1, ".XLSX").when(n % 5 == 2, ".txt").otherwise(".csv")
    )
    word = F.when(F.col("lang") == "fr", "Facilities").when(F.col("lang") == "de", "M4").otherwise("")
    name = F.concat(
        F.when(n % 11 == 0, "~$").otherwise(""), F.lit("s"), n.cast("string"), F.lit("_"), word, F.lower(F.hex("doc_id")), ext
    )
    return t.documents.select(
        "doc_id",
        F.concat_ws("/", "lang", "source", name).alias("path"),
        F.timestamp_seconds(n * 1000).alias("modificationTime"),
        n.alias("length"),
    )


@query("classify_files", f"{SQL_LISTING} SELECT doc_id, path, role FROM c")
def classify_files(spark, sf):
    files = listing(Tables(spark, sf))
    return files.select("doc_id", "path", C.input_role(F.col("path")).alias("role"))


@query("candidate_files", f"{SQL_LISTING} SELECT path, role FROM k")
def candidate_files(spark, sf):
    return discovery.candidate_files(listing(Tables(spark, sf))).select("path", "role")


@query("latest_file_per_role", f"{SQL_LISTING} SELECT role, arg_max(path, (m, path)) AS path FROM k GROUP BY 1")
def latest_file_per_role(spark, sf):
    return discovery.latest_per_role(discovery.candidate_files(listing(Tables(spark, sf)))).select("role", "path")


SQL_WIDE13 = """WITH w AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS file, n_name AS region_id, """ + ", ".join(
    f"CAST(SUM(CASE WHEN month(o_orderdate) = {m} THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS a{m - 1}" for m in range(1, 13)
) + """, CAST(COUNT(*) AS DOUBLE) AS a12
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def sheet_cells(t: Tables) -> DataFrame:
    """A sheet grid per order year. Odd years use the fixed layout, even ones a header row with other spellings,
    column order and a region column at the end; every file also has an unusable sheet of a preferred name."""
    daily = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"), F.count("*").alias("n")
    )
    rows = daily.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    months = [F.coalesce(F.sum(F.when(F.col("m") == m, F.col("v"))), F.lit(0)).cast("string").alias(f"a{m - 1}") for m in range(1, 13)]
    wide = rows.groupBy("y", "n_nationkey", "n_name").agg(*months, F.sum("n").cast("string").alias("a12"))

    def cell(col: int, value) -> F.Column:
        return F.struct(F.lit(col).alias("col"), value.alias("value"))

    n = len(ACTIVITIES)
    fixed = F.array(
        cell(0, F.col("n_nationkey").cast("string")), cell(1, F.lower("n_name")), *[cell(i + 2, F.col(f"a{i}")) for i in range(n)]
    )
    header = F.array(cell(n, F.col("n_name")), *[cell(n - 1 - i, F.col(f"a{i}")) for i in range(n)])
    titles = F.array(cell(n, F.lit("County")), *[cell(n - 1 - i, F.lit(a.upper().replace(" ", "-"))) for i, a in enumerate(ACTIVITIES)])
    odd = F.col("y") % 2 == 1
    file = F.col("y").cast("string").alias("file")
    data = wide.select(
        file, F.lit(0).alias("sheet_idx"), F.lit("Table 1").alias("sheet"), (F.col("n_nationkey") + 3).alias("row"), F.inline(F.when(odd, fixed).otherwise(header))
    )
    years = wide.select("y").distinct()
    heads = years.filter(~odd).select(file, F.lit(0).alias("sheet_idx"), F.lit("Table 1").alias("sheet"), F.lit(2).alias("row"), F.inline(titles))
    notes = years.select(
        file, F.lit(1).alias("sheet_idx"), F.lit("DEMAND").alias("sheet"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit("see table 1").alias("value")
    )
    return data.unionByName(heads).unionByName(notes)


@query("resolve_layout", f"{SQL_WIDE13} SELECT * FROM w")
def resolve_layout(spark, sf):
    wide = L.resolve_wide_layout(sheet_cells(Tables(spark, sf))).drop("row")
    return wide.toDF("file", "region_id", *[f"a{i}" for i in range(len(ACTIVITIES))])


@query(
    "sheet_layouts",
    """SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS file, 0 AS sheet_idx, CAST(1 - year(o_orderdate) % 2 AS INTEGER) AS layout,
2 AS header_row, CASE WHEN year(o_orderdate) % 2 = 1 THEN 1 ELSE 13 END AS region_col FROM orders""",
)
def sheet_layouts(spark, sf):
    return L.find_layouts(sheet_cells(Tables(spark, sf))).drop("activity_cols")


@query("unresolved_files", "SELECT DISTINCT 'notes ' || c_mktsegment AS file FROM customer")
def unresolved_files(spark, sf):
    """Files that hold no demand table are reported."""
    t = Tables(spark, sf)
    other = t.customer.select(
        F.concat(F.lit("notes "), "c_mktsegment").alias("file"),
        F.lit(0).alias("sheet_idx"),
        F.lit("data").alias("sheet"),
        F.col("c_custkey").cast("int").alias("row"),
        F.lit(0).alias("col"),
        F.col("c_name").alias("value"),
    )
    return L.unresolved_files(sheet_cells(t).unionByName(other))


@query(
    "geojson_roundtrip",
    """SELECT c_name AS facility_id, n_name AS region_id, 'unknown' AS facility_type, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS capacity,
c_acctbal / 100 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def geojson_roundtrip(spark, sf):
    """Facilities to GeoJSON feature lines and back."""
    t = Tables(spark, sf)
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("facility_id"),
        F.col("n_name").alias("region_id"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("capacity"),
        G.point(F.col("c_acctbal") / 100, F.col("c_nationkey")).alias("geometry"),
    )
    back = features.facility_features(features.parse_feature_lines(writers.feature_lines(rows)))
    g = F.col("geometry")
    return back.select("facility_id", "region_id", "facility_type", "capacity", G.point_x(g).alias("x"), G.point_y(g).alias("y"))


@query(
    "supply_from_features",
    """SELECT n_name AS region_id, CASE WHEN SUM(CAST(c_acctbal AS DECIMAL(18,2))) > 0
THEN ROUND(CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), 2) END AS supply_value FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def supply_from_features(spark, sf):
    """Facilities without ids in features get content hashes; their capacities are added up per region."""
    t = Tables(spark, sf)
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("region_id"), F.col("c_acctbal").alias("capacity"), G.point(F.col("c_custkey"), F.col("c_nationkey")).alias("geometry")
    )
    supply = U.supply_from_facilities(features.facility_features(features.parse_feature_lines(writers.feature_lines(rows))))
    return supply.withColumn("supply_value", F.round("supply_value", 2))


@query(
    "latest_run",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)",
)
def latest_run(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return results.latest_run(orders, "o_orderdate").drop("o_orderdate")


@query(
    "latest_run_by_status",
    """SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders JOIN (SELECT o_orderstatus, MAX(o_orderdate) AS o_orderdate FROM orders GROUP BY 1)
USING (o_orderstatus, o_orderdate)""",
)
def latest_run_by_status(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return results.latest_run(orders, "o_orderdate", ["o_orderstatus"]).select("o_orderstatus", "o_orderkey", "o_totalprice")


@query(
    "export_and_read_back",
    f"""WITH {SQL_NATION_DEMAND}, {SQL_NATION_SUPPLY},
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(100.0, 0.5, 1.0)} SELECT {NEED_COLUMNS} FROM n""",
)
def export_and_read_back(spark, sf):
    """A run written with all its copies to the shared folder, and the newest stored run read again."""
    t = Tables(spark, sf)
    root = f"{shared_folder(spark)}/results-{uuid.uuid4()}"
    run = score_regions(nation_demand(t), U.supply_from_facilities(nation_facilities(t)))
    writers.export_results(run, root, run_ts="20250101T000000Z")
    return tidy(results.read_results(spark, root, "need_table").drop("vintage", "run_ts"))
