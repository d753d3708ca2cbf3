import json
import os

import pytest

from regional_balance.functions import geometry as G
from regional_balance.plans import batch
from regional_balance.plans.ranking import activity_ranking, activity_scores_table
from regional_balance.schema import ACTIVITIES
from regional_balance.sources import results
from pyspark.sql import functions as F


def write(path, text, mtime):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (mtime, mtime))
    return str(path)


def sheet_csv(values):
    lines = ["Demand at origin", "x", "x"]
    lines += [",".join([str(i), region, *[str(v)] * len(ACTIVITIES)]) for i, (region, v) in enumerate(values)]
    return "\n".join(lines)


def test_newest_files_are_scored_and_exported(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw / "old" / "D8_2024.csv", "region_id,demand_value\nold,1\n", 1000)
    write(raw / "new" / "D8_2025.csv", sheet_csv([("albany", 2), ("erie", 6), ("GRAND TOTAL", 8)]), 2000)
    write(raw / "supply.csv", "County,Park,capacity\nAlbany,2,4\nErie,0,8\n", 1500)
    shapes = {
        "type": "FeatureCollection",
        "features": [{"type": "Feature", "properties": {"NAME_2": "Albany"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}],
    }
    bounds = write(tmp_path / "bounds.geojson", json.dumps(shapes, indent=1), 1)
    run = batch.score_files(spark, str(raw), boundaries=bounds, export_to=str(tmp_path / "out"), activity="Park", normalize=False)
    got = {r.region_id: (r.demand_value, r.supply_value, r.need_score) for r in run.need_table.collect()}
    assert got == {"Albany": (8.0, 4.0, 200.0), "Erie": (8.0, 8.0, 100.0)}
    metrics = {(r.region_id, r.activity): r.need_score for r in run.activity_metrics.collect()}
    assert metrics[("ALBANY", "Park")] == 400.0 and metrics[("ERIE", "Park")] is None and metrics[("ERIE", "Camping")] == 100.0
    assert len(metrics) == 2 * len(ACTIVITIES)
    assert batch.has_scores(run)
    assert results.read_results(spark, str(tmp_path / "out"), "need_table").count() == 2
    assert results.read_current(spark, str(tmp_path / "out"), "activity_metrics_by_county").count() == 26


def test_explicit_files_and_constant_supply(spark, tmp_path):
    demand = write(tmp_path / "demand.csv", "region_id,demand_value\na,0.5\nb,\n", 1)
    run = batch.score_files(spark, demand=demand)
    assert {r.region_id: r.need_score for r in run.need_table.collect()} == {"a": 50.0, "b": 0.0}
    supply = write(tmp_path / "fac.geojson", json.dumps({"type": "Feature", "properties": {"region_id": "a", "capacity": 0}, "geometry": None}), 1)
    assert not batch.has_scores(batch.score_files(spark, demand=demand, supply=supply))


def test_unusable_demand_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        batch.score_files(spark)
    with pytest.raises(ValueError, match="unsupported"):
        batch.load_demand(spark, "D8.xlsx")
    with pytest.raises(ValueError, match="layout"):
        batch.load_demand(spark, write(tmp_path / "d8.csv", "a,b\n1,2\n", 1))


def test_activity_ranking(spark):
    demand = spark.createDataFrame([("x", 3.0), ("y", 1.0), ("Subtotal", 4.0)], "region_id string, Park double")
    supply = spark.createDataFrame([("a", 2.0), ("b", 0.0), ("c", 8.0), ("Grand Total", 10.0)], "region string, park double")
    layer = spark.createDataFrame([("A",), ("C",), ("Z",)], "region_id string")
    layer = layer.withColumn("geometry", F.when(F.col("region_id") != "C", G.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1))))
    ranking = activity_ranking(demand, supply, "Park", layer)
    assert [(r.Region, r.score_text) for r in ranking.rows.collect()] == [("A", "200.000"), ("C", "50.000"), ("B", "-")]
    assert ranking.stats.first().asDict() == {"supply_rows": 3, "matched_rows": 3, "scored_rows": 2}
    assert sorted((r.region_id, r.activity_need_score, r.score_bin) for r in ranking.layer.collect()) == [("A", 200.0, 1), ("Z", None, None)]  # one score alone: a flat range, lowest class
    up = activity_ranking(demand, supply, "Park", descending=False, limit=1)
    assert [r.Region for r in up.rows.collect()] == ["C"]
    assert activity_scores_table(demand, supply, "Camping").count() == 0
    assert activity_scores_table(demand, supply).select("activity").distinct().count() == 1
