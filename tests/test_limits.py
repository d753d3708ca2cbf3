"""Values and inputs beyond the usual: large ids and scores, deep folders, low headers, raw rejects, failed writes."""

import pytest
from pyspark.sql import functions as F

from regional_balance.functions import columns as C
from regional_balance.operators import layout as L
from regional_balance.operators import metrics as M
from regional_balance.operators import validate as V
from regional_balance.plans import batch
from regional_balance.schema import ACTIVITIES
from regional_balance.sinks import writers
from regional_balance.sources import results


def test_whole_ids_of_any_size(spark):
    values = [1e38, 1e300, 123456789012345680.0, 36001.0, 1.5, -0.0, float("inf"), float("nan"), None, 1e37, 9.9e36]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.k for r in df.select(C.merge_key(df, "v").alias("k")).collect()]
    assert got == ["1" + "0" * 38, "1" + "0" * 300, "123456789012345680", "36001", "1.5", "0", "INFINITY", "", "", "1" + "0" * 37, "99" + "0" * 35]


def test_scores_of_any_size(spark):
    values = [0.25, 2.5, -1.0005, 1e15 + 0.5, 2.0**53, 1e19, -1e25, 1e300, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.t for r in df.select(C.score_text(F.col("v")).alias("t")).collect()]
    assert got[:4] == [f"{v:.3f}" for v in values[:4]]
    assert got[4:] == ["9007199254740992.000", "1" + "0" * 19 + ".000", "-1" + "0" * 25 + ".000", "1" + "0" * 300 + ".000", "-"]


def sheet(header_row):
    head = ["County", *ACTIVITIES]
    rows = [["note"]] * header_row + [head] + [["Kent", *["2"] * len(ACTIVITIES)], ["Erie", *["3"] * len(ACTIVITIES)]]
    return "\n".join(",".join(r) for r in rows) + "\n"


def test_deep_files_and_low_headers(spark, tmp_path):
    deep = tmp_path / "a" / "b" / "c" / "d" / "e"
    deep.mkdir(parents=True)
    (deep / "demand.csv").write_text(sheet(20))
    (tmp_path / "a" / "supply.csv").write_text("region_id,capacity\nKent,4\nErie,0\n")
    (tmp_path / "demand.xlsx").write_text("x")
    with pytest.raises(FileNotFoundError):
        batch.score_files(spark, raw=str(tmp_path))
    with pytest.raises(ValueError):
        batch.score_files(spark, raw=str(tmp_path), max_depth=6)
    run = batch.score_files(spark, raw=str(tmp_path), max_depth=6, rules=L.LayoutRules(header_rows=None))
    assert sorted(r.region_id for r in run.need_table.collect()) == ["Erie", "Kent"]
    assert [(r.path.rsplit("/", 1)[1], r.reason) for r in run.skipped.collect()] == [("demand.xlsx", "file type not read")]
    left = {(r.path.rsplit("/", 1)[1], r.reason) for r in batch.skipped_inputs(spark, str(tmp_path)).collect()}
    assert left == {("demand.xlsx", "file type not read"), ("demand.csv", "below the listing depth")}


def test_rejects_keep_what_came(spark):
    df = spark.createDataFrame([("a", "ten", "5"), ("b", "10", "5"), (None, "3", "x")], "region_id string, population string, participants string")
    checked = V.clean_survey(df)
    raw = {r.region_id: r.raw_values for r in checked.rejects.collect()}
    assert raw["a"] == {"region_id": "a", "population": "ten", "participants": "5"} and raw[None]["participants"] == "x"
    assert checked.valid.columns == ["region_id", "population", "participants"]


def test_a_failed_publication_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    writers.write_current(spark.range(5), root, "t", "one")
    bad = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("late")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="late"):
        writers.write_current(bad, root, "t", "two")
    assert results.read_current(spark, root, "t").count() == 5
    before = results.read_current(spark, root, "t")
    writers.write_current(spark.range(7), root, "t", "three")
    assert before.count() == 5 and results.read_current(spark, root, "t").count() == 7
    writers.write_current(spark.range(8), root, "t", "four")
    assert results.read_current(spark, root, "t").count() == 8
    assert len([p for p in (tmp_path / "current" / "t").iterdir() if p.name.startswith("copy-")]) <= 3
    writers.write_csv(spark.range(3), f"{root}/x.csv")
    with pytest.raises(Exception, match="late"):
        writers.write_csv(bad, f"{root}/x.csv")
    assert spark.read.option("header", "true").csv(f"{root}/x.csv").count() == 3
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_staged")]
    with pytest.raises(FileNotFoundError):
        results.read_current(spark, root, "nothing")


def test_counts_are_observed_while_writing(spark, tmp_path):
    scores = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "Region string, ActivityNeedScore double")
    watched, counts = M.observed(scores)
    watched.write.parquet(str(tmp_path / "x"))
    assert counts.get == M.row_stats(scores).first().asDict()


def test_repeated_activity_demand_is_an_error(spark):
    supply = spark.createDataFrame([("k", "Park", 1.0)], "region_id string, activity string, supply_value double")
    demand = spark.createDataFrame([("Park", 1.0), ("Park", 2.0)], "activity string, demand_value double")
    with pytest.raises(Exception, match="more than one row for Park"):
        M.activity_metrics(demand, supply, activities=["Park"]).collect()
    assert M.activity_metrics(demand, supply).count() == 2
