"""Files: what a run writes, read again; listings; the batch run on files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regional_balance import score_regions
from regional_balance.functions import geometry as G
from regional_balance.operators import metrics as M
from regional_balance.operators import supply as U
from regional_balance.plans.alignment import Aligned
from regional_balance.plans.batch import score_files
from regional_balance.session import shared_folder
from regional_balance.sinks import writers
from regional_balance.sources import discovery, features, results, tabular
from workload.registry import SQL_NATION_DEMAND, SQL_NATION_SUPPLY, Tables, nation_demand, nation_facilities, query, sql_need
from workload.scores import NEED_COLUMNS, tidy
from workload.spatial import SQL_GRID, grid

SQL_NEED = f"""{SQL_NATION_DEMAND}, {SQL_NATION_SUPPLY},
j AS (SELECT region_id, COALESCE(demand_value, 0.0) AS demand_value, supply_value FROM d FULL JOIN s USING (region_id)),
{sql_need(100.0, 0.5, 1.0)}"""


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


def nation_run(t: Tables, boundaries: DataFrame | None = None):
    return score_regions(nation_demand(t), U.supply_from_facilities(nation_facilities(t)), boundaries)


@query("current_copy", f"WITH {SQL_NEED} SELECT {NEED_COLUMNS} FROM n WHERE region_id < 'M'")
def current_copy(spark, sf):
    """Published twice: readers get the second copy."""
    t, root = Tables(spark, sf), fresh_folder(spark, "current")
    table = nation_run(t).need_table
    writers.write_current(table, root, "need", "first")
    writers.write_current(table.filter("region_id < 'M'"), root, "need", "second")
    return tidy(results.read_current(spark, root, "need"))


@query("run_bundle", f"WITH {SQL_NEED} SELECT {NEED_COLUMNS} FROM n")
def run_bundle(spark, sf):
    """The folder of one run."""
    t, root = Tables(spark, sf), fresh_folder(spark, "bundle")
    writers.export_results(nation_run(t), root, run_ts="20250101T000000Z")
    return tidy(spark.read.parquet(f"{root}/exports/run_20250101T000000Z/need_table"))


@query(
    "exported_csv",
    f"""WITH {SQL_NEED} SELECT region_id, ROUND(demand_value, 2) AS demand_value, ROUND(supply_value, 2) AS supply_value, need_class,
CAST(priority_rank AS BIGINT) AS priority_rank FROM n""",
)
def exported_csv(spark, sf):
    """The stable CSV of a run, typed again."""
    t, root = Tables(spark, sf), fresh_folder(spark, "csv")
    writers.export_results(nation_run(t), root)
    table = tabular.read_csv(spark, f"{root}/csv/need_score_by_region.csv")
    amounts = [F.round(F.col(c).cast("double"), 2).alias(c) for c in ("demand_value", "supply_value")]
    return table.select("region_id", *amounts, "need_class", F.col("priority_rank").cast("long").alias("priority_rank"))


@query("exported_layer", f"WITH {SQL_GRID} SELECT region_id, CAST(gx AS DOUBLE) AS x1, CAST(gy + 1 AS DOUBLE) AS y2 FROM g")
def exported_layer(spark, sf):
    """A run with its regions, written as GeoJSON in longitude and latitude, read and projected again."""
    t, root = Tables(spark, sf), fresh_folder(spark, "layer")
    writers.export_results(nation_run(t, grid(t)), root)
    layer = features.boundary_features(features.read_features(spark, f"{root}/geojson/need_score_map.geojson"), "region_id")
    box = G.bbox(F.col("geometry"))
    # Adding zero turns the -0.0 that a rounded tiny coordinate leaves into 0.0.
    return layer.select("region_id", (F.round(box["x1"], 6) + 0.0).alias("x1"), (F.round(box["y2"], 6) + 0.0).alias("y2"))


@query(
    "aligned_tables",
    """SELECT 'survey' AS name, COUNT(*) AS n FROM customer UNION ALL SELECT 'census', COUNT(*) FROM nation
UNION ALL SELECT 'facilities', COUNT(*) FROM supplier UNION ALL SELECT 'boundaries', COUNT(*) FROM nation""",
)
def aligned_tables(spark, sf):
    """Aligned inputs kept per table and unit, and read again by unit."""
    t, root = Tables(spark, sf), fresh_folder(spark, "aligned")
    aligned = Aligned(t.customer, t.nation, t.supplier, grid(t).select("region_id", "geometry"))
    writers.write_aligned(aligned.frames(), root, "county")
    counts = [
        spark.read.parquet(f"{root}/{name}").filter(F.col("unit") == "county").agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name in aligned.frames()
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3])


@query("listed_files", "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment FROM customer")
def listed_files(spark, sf):
    """Files two folders down are listed; so are the folders that hold them."""
    root = fresh_folder(spark, "listing")
    rows = Tables(spark, sf).customer.withColumns({"nation": F.col("c_nationkey"), "segment": F.col("c_mktsegment")})
    rows.repartition("nation", "segment").write.partitionBy("nation", "segment").option("header", "true").csv(root)
    path = F.col("path")
    listed = discovery.list_files(spark, root, max_depth=3).select(
        F.regexp_extract(path, "nation=([0-9]+)", 1).cast("long").alias("nation"), F.regexp_extract(path, "segment=([A-Z]+)", 1).alias("segment")
    )
    return listed.distinct()


@query("score_files", f"WITH {SQL_NEED}, {SQL_GRID} SELECT n.*, CAST(gx AS DOUBLE) AS x1 FROM (SELECT {NEED_COLUMNS} FROM n) n JOIN g USING (region_id)")
def score_from_files(spark, sf):
    """The newest demand and supply files of a folder, found by name, scored and joined to regions from GeoJSON."""
    t, root = Tables(spark, sf), fresh_folder(spark, "inputs")
    for name, value, table in (
        ("demand_2025.csv", "demand_value", nation_demand(t)),
        ("supply_2025.csv", "supply_value", U.supply_from_facilities(nation_facilities(t))),
    ):
        # One named file for each, as people hand them in: a line for each nation.
        line = F.concat(F.lit('"'), "region_id", F.lit('",'), F.coalesce(F.col(value).cast("decimal(28,2)").cast("string"), F.lit("")))
        text = table.agg(F.concat_ws("\n", F.collect_list(line)).alias("t")).first()["t"]
        folder = writers.Folder(spark, f"{root}/2025/{name.split('_')[0]}")
        folder.put_text(name, f"region_id,{value}\n{text}\n")
    bounds = writers.write_features(grid(t).withColumn("NAME_2", F.col("region_id")), f"{root}/bounds.geojson")
    run = score_files(spark, raw=f"{root}/2025", boundaries=bounds)
    return tidy(run.layer).select("*", (F.round(G.bbox(F.col("geometry"))["x1"], 6) + 0.0).alias("x1")).drop("geometry")


@query(
    "observed_counts",
    """SELECT COUNT(*) AS supply_rows, COUNT(*) AS matched_rows, COUNT(*) FILTER (WHERE s_acctbal <> 0) AS scored_rows FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def observed_counts(spark, sf):
    """Counts gathered while a ranking is written, without a job of their own."""
    t = Tables(spark, sf)
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    scores = rows.select("n_name", F.when(F.col("s_acctbal") != 0, 1 / F.col("s_acctbal")).alias("ActivityNeedScore"))
    watched, counts = M.observed(scores)
    watched.write.parquet(fresh_folder(spark, "observed"))
    return spark.createDataFrame([counts.get])
