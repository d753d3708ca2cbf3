import json
import os

import pytest
from pyspark.sql import functions as F

from regional_balance import score_regions
from regional_balance.functions import geometry as G
from regional_balance.sinks import writers
from regional_balance.sources import discovery, features, results, tabular


def touch(path, mtime, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (mtime, mtime))


def test_listing_and_latest(spark, tmp_path, plan):
    raw, top = tmp_path / "data" / "raw", tmp_path
    touch(raw / "D8_2024.xlsx", 1000)
    touch(raw / "a" / "b" / "c" / "demand_new.csv", 3000)
    touch(raw / "a" / "b" / "c" / "d" / "demand_deep.csv", 9000)
    touch(raw / "demand.geojson", 8000)
    touch(raw / "~$D8.xlsx", 9000)
    touch(raw / "S12.json", 100)
    touch(top / "supply_top.csv", 5000)
    touch(top / "supply_top.json", 9000)
    touch(top / "other" / "supply_deeper.csv", 9000)
    found = discovery.list_files(spark, str(raw), str(top))
    names = sorted(r.path.rsplit("/", 1)[1] for r in found.collect())
    assert names == ["D8_2024.xlsx", "S12.json", "demand.geojson", "demand_new.csv", "supply_top.csv", "~$D8.xlsx"]
    latest = {r.role: r.path.rsplit("/", 1)[1] for r in discovery.latest_per_role(discovery.candidate_files(found)).collect()}
    assert latest == {"demand": "demand_new.csv", "supply": "supply_top.csv"}
    assert "content" not in plan(found)


def test_equal_times_take_the_last_path(spark):
    rows = [("a/d8_1.csv", 5), ("a/d8_2.csv", 5), ("a/d8_0.csv", 4)]
    df = spark.createDataFrame(rows, "path string, t int").withColumn("modificationTime", F.timestamp_seconds("t"))
    got = discovery.latest_per_role(discovery.candidate_files(df)).collect()
    assert [(r.role, r.path) for r in got] == [("demand", "a/d8_2.csv")]


def test_demand_csv(spark, tmp_path):
    (tmp_path / "demand.csv").write_text(" Region_ID,x,Demand_Value \n a ,1,1e3\nb,1,abc\nc,1,\nd,1,nan\ne,1,1d\n")
    got = {r.region_id: r.demand_value for r in tabular.read_demand(spark, str(tmp_path / "demand.csv")).collect()}
    assert got == {"a": 1000.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": 0.0}
    with pytest.raises(ValueError):
        tabular.demand_from_csv(spark.createDataFrame([(1,)], "region_id int"))
    with pytest.raises(ValueError, match="unsupported"):
        tabular.read_demand(spark, "x.shp")


def test_ranking_demand(spark):
    df = spark.createDataFrame([("Erie ", "1", 2.0), (None, "3", 4.0), ("b", "x", None)], "place string, Park string, Camping double")
    got = tabular.ranking_demand(df)
    assert got.columns == ["Region", "Park", "Camping"]
    assert sorted(map(tuple, got.collect())) == [("B", None, None), ("ERIE", 1.0, 2.0)]
    with pytest.raises(ValueError):
        tabular.ranking_demand(df.select("place"))


def test_supply_files(spark, tmp_path):
    (tmp_path / "supply.csv").write_text("fips,note,amount\n36001,x,5\n36002,y,\n")
    got = {r.region_id: r.supply_value for r in tabular.read_supply(spark, str(tmp_path / "supply.csv")).collect()}
    assert got == {"36001": 5.0, "36002": None}
    collection = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"region_id": "a", "capacity": 2}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
            {"type": "Feature", "properties": {"region_id": "a", "capacity": "3.5"}, "geometry": None},
            {"type": "Feature", "properties": {"region_id": None}, "geometry": None},
        ],
    }
    (tmp_path / "facilities.geojson").write_text(json.dumps(collection, indent=1))
    got = [tuple(r) for r in tabular.read_supply(spark, str(tmp_path / "facilities.geojson")).collect()]
    assert got == [("a", 5.5)]
    with pytest.raises(ValueError, match="unsupported"):
        tabular.read_supply(spark, "roads.shp")


def test_features_without_region_are_an_error(spark, tmp_path):
    path = tmp_path / "facilities.geojson"
    path.write_text(json.dumps({"type": "Feature", "properties": {"capacity": 2}, "geometry": None}))
    with pytest.raises(Exception, match="region_id"):
        features.facility_features(features.read_features(spark, str(path))).collect()
    kept = features.facility_features(features.read_features(spark, str(path)), require_region=False).first()
    assert kept.region_id is None and kept.facility_id.startswith("fac_") and kept.facility_type == "unknown"


def test_boundaries_from_a_collection_with_crs(spark, tmp_path):
    ring = [[0, 0], [100, 0], [100, 100], [0, 0]]
    feats = [
        {"type": "Feature", "properties": {"NAME_2": n}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
        for n in ("Saint Lawrence", "Lake Ontario", " albany", None, "nan", "")
    ]
    feats.append({"type": "Feature", "properties": {"NAME_2": "Erie"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}})
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3857"}}, "features": feats}
    (tmp_path / "b.geojson").write_text(json.dumps(doc, indent=1))
    got = features.boundary_features(features.read_features(spark, str(tmp_path / "b.geojson")))
    assert sorted(r.region_id for r in got.collect()) == ["ALBANY", "ERIE", "ST. LAWRENCE"]
    assert {r.s for r in got.select(F.col("geometry.srid").alias("s")).collect()} == {3857}
    areas = {r.region_id: r.a for r in got.select("region_id", G.area(F.col("geometry")).alias("a")).collect()}
    assert areas == {"ALBANY": 5000.0, "ERIE": 10000.0, "ST. LAWRENCE": 5000.0}


def test_feature_lines_are_geojson(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1.5)], "region_id string, need_class string, need_score double")
    df = df.withColumn("geometry", G.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1)))
    path = writers.write_features(df.unionByName(df.withColumn("geometry", F.lit(None).cast(df.schema["geometry"].dataType))), str(tmp_path / "layer"))
    docs = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert {d["type"] for d in docs} == {"Feature"}
    assert docs[0]["properties"] == {"region_id": "a", "need_class": None, "need_score": 1.5}
    shapes = [d["geometry"] for d in docs if d["geometry"]]
    assert shapes == [{"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}]
    assert features.read_features(spark, path).count() == 2


def test_multipolygon_and_point_round_trip(spark):
    texts = [
        '{"type":"Feature","properties":{},"geometry":{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,0.0]]],[[[5.0,5.0],[6.0,5.0],[6.0,6.0],[5.0,5.0]]]]}}',
        '{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[1.5,2.5]}}',
    ]
    parsed = features.parse_feature_lines(spark.createDataFrame([(t,) for t in texts], "value string"))
    again = [json.loads(r.g) for r in parsed.select(G.to_geojson(F.col("geometry")).alias("g")).collect()]
    assert again == [json.loads(t)["geometry"] for t in texts]


def test_export_and_read_back(spark, tmp_path, plan):
    demand = spark.createDataFrame([("a", 3.0), ("b", 0.001)], "region_id string, demand_value double")
    supply = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "region_id string, supply_value double")
    bounds = spark.createDataFrame([("a",)], "region_id string").withColumn("geometry", G.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1), 3857))
    root = str(tmp_path / "out")
    for stamp, table in (("20250101T000000Z", demand), ("20250201T000000Z", demand.filter("region_id = 'a'"))):
        run = score_regions(table, supply.filter("region_id = 'a'") if stamp > "20250115" else supply, bounds)
        paths = writers.export_results(run, root, run_ts=stamp)
    assert [r.region_id for r in results.read_results(spark, root, "need_table").collect()] == ["a"]
    assert spark.read.parquet(f"{root}/need_table").count() == 3
    assert results.read_current(spark, root, "need_score_by_region").count() == 1
    assert results.read_current(spark, root, "priority_ranking").first().need_score == 300.0
    assert results.read_current(spark, root, "need_score_map").count() == 1
    csv = spark.read.option("header", "true").csv(paths["need_table.csv"])
    assert csv.columns == ["region_id", "demand_value", "supply_value", "need_score", "need_class", "priority_rank"]
    assert paths["need_table.csv"].endswith("need_table_2025_20250201T000000Z.csv")
    assert spark.read.option("header", "true").csv(f"{root}/csv/need_score_by_region.csv").count() == 1
    assert spark.read.parquet(f"{root}/exports/run_20250101T000000Z/need_improvement").count() == 1
    back = features.read_features(spark, paths["need_spatial.geojson"])
    assert back.first().properties["need_class"] == "Needs Improvement"
    text = plan(results.read_results(spark, root, "need_table", "2025"))
    assert "PartitionFilters" in text and "run_ts" in text.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_metrics_are_written_only_when_there_are_any(spark, tmp_path):
    wide = spark.createDataFrame([("a", 1.0)], "region_id string, Park double")
    supply = spark.createDataFrame([("a", 2.0)], "county string, capacity double")
    writers.export_results(score_regions(wide, supply), str(tmp_path / "one"), run_ts="t", bundle=False)
    assert results.read_current(spark, str(tmp_path / "one"), "activity_metrics_by_county").count() == 1
    empty = score_regions(wide, supply.filter("false"))
    writers.export_results(empty, str(tmp_path / "two"), run_ts="t", bundle=False)
    assert not (tmp_path / "two" / "current" / "activity_metrics_by_county").exists()
    assert not (tmp_path / "two" / "exports").exists()


def test_aligned_tables(spark, tmp_path):
    paths = writers.write_aligned({"survey": spark.range(3).toDF("region_id")}, str(tmp_path), "county")
    assert spark.read.parquet(paths["survey"]).count() == 3
    assert spark.read.parquet(str(tmp_path / "survey")).first().unit == "county"


def test_latest_run_by_group(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "vintage string, run_ts int, v string")
    assert [r.v for r in results.latest_run(df).collect()] == ["y"]
    assert sorted(r.v for r in results.latest_run(df, by=["vintage"]).collect()) == ["y", "z"]


def test_a_run_written_twice_is_there_once(spark, tmp_path):
    from regional_balance.sinks.writers import write_run

    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "region_id string, need_score double")
    for run in ("r1", "r2", "r1"):
        path = write_run(df, str(tmp_path), "need_table", run)
    assert spark.read.parquet(path).groupBy("run_ts").count().orderBy("run_ts").collect() == [("r1", 2), ("r2", 2)]


def test_deep_files_are_listed_or_reported(spark, tmp_path):
    from regional_balance.sources.discovery import list_files, too_deep

    deep = tmp_path / "a/b/c/d/e"
    deep.mkdir(parents=True)
    (deep / "D8.csv").write_text("x")
    (tmp_path / "a/S1.csv").write_text("x")
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    assert names(list_files(spark, str(tmp_path))) == ["S1.csv"]
    assert names(too_deep(spark, str(tmp_path))) == ["D8.csv"]
    assert names(list_files(spark, str(tmp_path), max_depth=None)) == ["D8.csv", "S1.csv"]
