import math

import pytest
from pyspark.sql import functions as F

from regional_balance import score_regions
from regional_balance.operators import clean as K
from regional_balance.operators import demand as D
from regional_balance.operators import metrics as M
from regional_balance.operators import score as R
from regional_balance.operators import supply as U
from regional_balance.schema import ACTIVITIES, ACTIVITY_METRICS, NEED_TABLE, ScoreParams


def rows(df, *names):
    return sorted((tuple(r[n] for n in (names or df.columns)) for r in df.collect()), key=str)


def demand(spark, *pairs):
    return spark.createDataFrame(list(pairs), "region_id string, demand_value double")


def supply(spark, *pairs):
    return spark.createDataFrame(list(pairs), "region_id string, supply_value double")


# --- J1 --------------------------------------------------------------------------------------------


def test_combine_keeps_both_sides_and_multiplies_repeats(spark):
    d = demand(spark, ("a", 1.0), ("a", 2.0), ("b", 3.0), ("only_d", 4.0), (None, 5.0))
    s = supply(spark, ("a", 10.0), ("a", 20.0), ("b", 30.0), ("only_s", 40.0), (None, 50.0))
    split = R.combine(d, s)
    plain = R.combine(d, s, keys_unique=True)
    assert rows(split) == rows(plain)
    assert len(rows(split)) == 4 + 1 + 4
    assert ("only_s", 0.0, 40.0) in rows(split) and ("only_d", 4.0, None) in rows(split)


def test_combine_with_more_keys(spark):
    d = spark.createDataFrame([("x", "a", 1.0), ("y", "a", 2.0)], "layer string, region_id string, demand_value double")
    s = spark.createDataFrame([("x", "a", 4.0), ("z", "a", 8.0)], "layer string, region_id string, supply_value double")
    assert rows(R.combine(d, s, ["layer"])) == rows(R.combine(d, s, ["layer"], keys_unique=True))


def test_need_table_schema_and_missing_columns(spark):
    table = R.need_table(demand(spark, ("a", 1.0)), supply(spark, ("a", 2.0)))
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in NEED_TABLE]
    with pytest.raises(ValueError, match="demand_value"):
        R.need_table(spark.createDataFrame([("a",)], "region_id string"), supply(spark, ("a", 2.0)))
    with pytest.raises(ValueError):
        R.need_table(demand(spark), supply(spark), dedupe_supply="mean")


def test_zero_negative_and_missing_supply(spark):
    d = demand(spark, ("zero", 5.0), ("neg", 5.0), ("none", 5.0), ("ok", 5.0))
    s = supply(spark, ("zero", 0.0), ("neg", -5.0), ("ok", 500.0), ("nan", float("nan")))
    got = {r.region_id: (r.need_score, r.need_class, r.priority_rank) for r in R.need_table(d, s).collect()}
    assert got["zero"] == (None, None, None)
    assert got["neg"] == (-100.0, "Supply Sufficient", 2)
    assert got["none"] == (None, "Needs Improvement (No Supply)", None)
    assert got["nan"] == (None, "Needs Improvement (No Supply)", None)
    assert got["ok"] == (1.0, "Balanced", 1)
    nulled = {r.region_id: r.need_class for r in R.need_table(d, s, nonpositive_supply="null").collect()}
    assert nulled["zero"] == nulled["neg"] == "Needs Improvement (No Supply)"


def test_improvement_list_order(spark):
    d = demand(spark, ("b", 3.0), ("a", 3.0), ("none", 1.0), ("low", 0.001), ("top", 9.0))
    s = supply(spark, ("b", 1.0), ("a", 1.0), ("low", 1.0), ("top", 1.0))
    table = R.need_table(d, s)
    assert [r.region_id for r in R.improvement_list(table).collect()] == ["top", "a", "b", "none"]
    assert {r.region_id: r.priority_rank for r in table.collect()} == {"top": 1, "a": 2, "b": 2, "low": 4, "none": None}


def test_archived_scores(spark):
    """Values of an archived run with scale 1000 and bands 5 and 10; ranks within this excerpt."""
    archived = [
        ("STATEWIDE TOTAL", 1.0, 1000.0, "Needs Improvement"),
        ("KINGS", 0.14563575696513806, 145.63575696513806, "Needs Improvement"),
        ("SUFFOLK", 0.07113449952137699, 71.13449952137698, "Needs Improvement"),
        ("NASSAU", 0.06450852975092497, 64.50852975092496, "Needs Improvement"),
        ("SCHOHARIE", 0.001398831482017117, 1.398831482017117, "Supply Sufficient"),
        ("LEWIS", 0.0011059960055952737, 1.1059960055952738, "Supply Sufficient"),
        ("HAMILTON", 0.00020156161448438843, 0.20156161448438842, "Supply Sufficient"),
        ("NAN", 0.0, 0.0, "Supply Sufficient"),
    ]
    d = demand(spark, *[(r, v) for r, v, _, _ in archived])
    s = U.supply_constant(d.select("region_id"))
    table = R.need_table(d, s, params=ScoreParams(1000.0, 5.0, 10.0))
    got = {r.region_id: r for r in table.collect()}
    for place, (region, _, score, klass) in enumerate(archived, 1):
        assert math.isclose(got[region].need_score, score, rel_tol=1e-14)
        assert got[region].need_class == klass and got[region].priority_rank == place
    listed = [r.region_id for r in R.improvement_list(table, 1.2).collect()]
    assert listed == [r for r, *_ in archived[:5]]


def test_geometry_join_ranks_first_unless_asked(spark):
    table = R.need_table(demand(spark, ("a", 2.0), ("b", 1.0)), supply(spark, ("a", 1.0), ("b", 1.0)))
    bounds = spark.createDataFrame([("a", "p1"), ("a", "p2"), ("c", "p3")], "region_id string, geometry string")
    got = R.attach_geometry(table, bounds)
    assert rows(got, "region_id", "geometry", "priority_rank") == [("a", "p1", 1), ("a", "p2", 1), ("b", None, 2)]
    again = R.attach_geometry(table, bounds, rank_after_join=True)
    assert rows(again, "region_id", "priority_rank") == [("a", 1), ("a", 1), ("b", 3)]


def test_top_regions_missing_last_both_ways(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 1.0)], "region_id string, need_score double")
    assert [r.region_id for r in R.top_regions(df, 4).collect()] == ["c", "a", "d", "b"]
    assert [r.region_id for r in R.top_regions(df, 4, descending=False).collect()] == ["a", "d", "c", "b"]
    assert [r.region_id for r in R.top_regions(df, 1, descending=False).collect()] == ["a"]
    assert [r.region_id for r in R.top_regions(df).collect()] == ["c", "a", "d", "b"]


def test_top_regions_per_group_limits_before_the_shuffle(spark, plan):
    df = spark.createDataFrame([(g, str(i), float(i)) for g in "xy" for i in range(5)], "g string, region_id string, need_score double")
    top = R.top_regions(df, 2, by=["g"])
    assert rows(top, "g", "region_id", "place") == [("x", "3", 2), ("x", "4", 1), ("y", "3", 2), ("y", "4", 1)]
    assert "WindowGroupLimit" in plan(top)


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 2, "z"), ("b", 1, "y")], "k string, o int, v string")
    assert rows(R.keep_last(df, ["k"], ["o"])) == [("a", 3, None), ("b", 1, "y")]


# --- demand ----------------------------------------------------------------------------------------


def wide(spark):
    data = [
        ("albany", "1", "2", " 3 "),
        ("bronx", None, "x", "-1"),
        ("GRAND TOTAL", "100", "100", "100"),
        (None, "1", "1", "1"),
    ]
    return spark.createDataFrame(data, "region_id string, Park string, `walking/jogging` string, Camping string")


def test_demand_long_round_trip(spark):
    long = D.demand_long(wide(spark))
    assert set(r.activity for r in long.collect()) == {"Park", "Walking/Jogging", "Camping"}
    assert ("bronx", "Walking/Jogging", 0.0) in rows(long) and ("bronx", "Camping", -1.0) in rows(long)
    back = long.filter("region_id = 'albany'").groupBy("region_id").pivot("activity", ["Park", "Walking/Jogging", "Camping"]).sum("demand")
    assert rows(back) == [("albany", 1.0, 2.0, 3.0)]
    assert D.demand_long(wide(spark), ["Golfing"]).count() == 0


def test_activity_demand(spark):
    assert rows(D.activity_demand(wide(spark))) == [("Camping", 3.0), ("Park", 2.0), ("Walking/Jogging", 3.0)]
    mean = {r.activity: r.demand_value for r in D.activity_demand(wide(spark), how="mean").collect()}
    assert mean == {"Camping": 1.0, "Park": pytest.approx(2 / 3), "Walking/Jogging": 1.0}
    long = D.demand_long(wide(spark))
    assert rows(D.activity_demand_from_long(long)) == rows(D.activity_demand(wide(spark)))
    assert rows(D.activity_demand_from_long(long, "mean")) == rows(D.activity_demand(wide(spark), how="mean"))
    with pytest.raises(ValueError):
        D.activity_demand(wide(spark), how="median")
    assert D.activity_demand(wide(spark), ["Golfing"]).count() == 0


def test_scalar_demand(spark):
    per = D.activity_demand(wide(spark))
    assert rows(D.scalar_demand(per)) == [(8.0,)]
    assert rows(D.scalar_demand(per, " PARK ")) == [(2.0,)]
    assert rows(D.scalar_demand(per, "park", normalize=True)) == [(0.25,)]
    assert rows(D.scalar_demand(per, normalize=True)) == [(1.0,)]
    assert rows(D.scalar_demand(per.filter("false"), "park", normalize=True)) == [(0.0,)]
    with pytest.raises(ValueError, match="Polo"):
        D.scalar_demand(per, "Polo", known=["Park"])


def test_spread_demand_is_a_subquery_not_a_join(spark, plan):
    per = D.activity_demand(wide(spark))
    regions = spark.createDataFrame([("a",), ("b",)], "region_id string")
    spread = D.spread_demand(regions, D.scalar_demand(per))
    assert rows(spread) == [("a", 8.0), ("b", 8.0)]
    assert "Join" not in plan(spread)


def test_survey_and_table_demand(spark):
    survey = spark.createDataFrame([("a", 10, 5), ("b", 0, 5), ("c", None, 5), ("d", 10, None)], "region_id string, population long, participants long")
    assert rows(D.demand_from_survey(survey)) == [("a", 0.5), ("b", 0.0), ("c", 0.0), ("d", 0.0)]
    assert rows(D.demand_from_survey(survey, use_rate=False))[2] == ("c", 5.0)
    assert rows(D.demand_from_survey(survey.drop("population")))[0] == ("a", 5.0)
    table = spark.createDataFrame([(1, "7"), (2, "n/a"), (3, None)], "region_id long, v string")
    assert rows(D.demand_from_table(table, "v")) == [("1", 7.0), ("2", 0.0), ("3", 0.0)]


# --- supply ----------------------------------------------------------------------------------------


def test_supply_from_facilities(spark):
    data = [("a", "1", 5.0), ("a", "2", None), ("none", "3", None), ("neg", "4", -5.0), ("neg", "5", 5.0), (None, "6", 9.0), ("noid", None, None)]
    f = spark.createDataFrame(data, "region_id string, facility_id string, capacity double")
    assert rows(U.supply_from_facilities(f)) == [("a", 5.0), ("neg", None), ("noid", None), ("none", None)]
    assert rows(U.supply_from_facilities(f, count_fallback=True)) == [("a", 5.0), ("neg", None), ("noid", None), ("none", 1.0)]
    assert rows(U.supply_from_facilities(f, use_capacity=False)) == [("a", 2.0), ("neg", 2.0), ("noid", None), ("none", 1.0)]


def test_tabular_supply_roles(spark):
    named = spark.createDataFrame([(1, " Erie ", "7", 3.0)], "n long, ` County` string, Capacity string, other double")
    assert rows(U.tabular_supply(named)) == [("Erie", 7.0)]
    codes = spark.createDataFrame([(36001, "x", 3.0), (36001, "y", 0.0)], "fips long, note string, amount double")
    assert rows(U.tabular_supply(codes)) == [("36001", 0.0), ("36001", 3.0)]
    with pytest.raises(ValueError, match="numeric"):
        U.tabular_supply(spark.createDataFrame([("a", "b")], "region string, note string"))


def test_supply_keyed(spark):
    s = supply(spark, ("albany", 1.0), (" ALBANY", 2.0), ("36001.0", 1.0), ("36001", None), ("Subtotal", 9.0), (" ", 9.0), (None, 9.0), ("empty", None))
    assert rows(U.supply_keyed(s)) == [("36001", 1.0), ("ALBANY", 3.0), ("EMPTY", 0.0)]


def test_activity_supply(spark, plan):
    t = spark.createDataFrame([("a", 1.0, 10.0), ("A ", 2.0, 20.0), ("b", None, 5.0)], "county string, PARK double, supply double")
    got = U.activity_supply(t, ["Park", "Camping"])
    assert rows(got) == [("A", "Camping", 30.0), ("A", "Park", 3.0), ("B", "Camping", 5.0), ("B", "Park", 0.0)]
    only = U.activity_supply(spark.createDataFrame([("a", 1.0)], "county string, park double").withColumn("park", F.col("park").cast("string")), ["Park", "Camping"])
    assert rows(only) == [("A", "Park", 1.0)]


def test_activity_supply_from_sheets(spark):
    one = spark.createDataFrame([("note",)], "text string")
    empty = spark.createDataFrame([("Grand Total", 5.0)], "region string, park double")
    first = spark.createDataFrame([("a", "1")], "region string, park string")
    second = spark.createDataFrame([("a", 7.0)], "region string, capacity double")
    got = U.activity_supply_from_sheets([one, empty, first, second], ["Park", "Camping"])
    assert rows(got) == [("A", "Camping", 7.0), ("A", "Park", 1.0)]


# --- metrics ---------------------------------------------------------------------------------------


def test_activity_metrics(spark, plan):
    per = spark.createDataFrame([("Park", 10.0), ("Camping", 0.0), ("Golfing", 3.0)], "activity string, demand_value double")
    s = spark.createDataFrame([("A", "Park", 4.0), ("B", "Park", 0.0), ("A", "Camping", 2.0), ("A", "Polo", 1.0)], "region_id string, activity string, supply_value double")
    got = M.activity_metrics(per, s)
    assert [f.name for f in got.schema] == [f.name for f in ACTIVITY_METRICS]
    assert rows(got) == [
        ("A", "Camping", 0.0, 2.0, -2.0, None, 0.0),
        ("A", "Park", 10.0, 4.0, 6.0, 0.4, 250.0),
        ("B", "Park", 10.0, 0.0, 10.0, 0.0, None),
    ]


def test_activity_scores_of_an_unknown_activity_are_empty(spark):
    per = spark.createDataFrame([("Park", 10.0)], "activity string, demand_value double")
    s = spark.createDataFrame([("A", "Park", 4.0), ("GRAND TOTAL", "Park", 4.0)], "region_id string, activity string, supply_value double")
    assert rows(M.activity_scores(per, s, "Park"), "Region", "ActivityNeedScore") == [("A", 250.0)]
    assert M.activity_scores(per, s, "Polo").count() == 0
    assert rows(M.row_stats(M.activity_scores(per, s))) == [(1, 1, 1)]


def test_summary(spark):
    data = [("b", 2.0, "Needs Improvement"), ("a", 2.0, "Needs Improvement (No Supply)"), ("c", None, None), ("c", 1.0, "Balanced")]
    df = spark.createDataFrame(data, "region_id string, need_score double, need_class string")
    assert rows(M.summary(df)) == [(3, 2, pytest.approx(5 / 3), 2.0, "a")]
    assert rows(M.summary(df, approximate=True))[0][0] == 3
    assert rows(M.summary(df.filter("false"))) == [(0, 0, None, None, None)]
    assert rows(M.summary(df.filter("need_score is null"))) == [(1, 0, None, None, None)]


def test_class_breaks(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.999,), (10.0,), (None,)], "need_score double")
    assert rows(M.class_breaks(df)) == [([0.0, 2.0, 4.0, 6.0, 8.0, 10.0],)]
    assert rows(M.with_class_bin(df)) == [(0.0, 1), (1.0, 1), (10.0, 5), (4.999, 3), (None, None)]
    flat = spark.createDataFrame([(0.5,)], "need_score double")
    edges = M.class_breaks(flat).first().edges
    assert edges[0] == 0.5 and edges[-1] == 0.5 + 1e-12
    assert rows(M.class_breaks(df.filter("need_score is null"))) == [(None,)]


def test_layer_join(spark):
    layer = spark.createDataFrame([("Erie", 1.0, "g1"), ("36001", 1.0, "g2"), ("Kings", 1.0, "g3")], "region_id string, need_score double, geometry string")
    scores = spark.createDataFrame([(" ERIE", 1.0, 1), ("erie", 2.0, 2), ("36001.0", 3.0, 1)], "Region string, ActivityNeedScore double, seq int")
    got = M.layer_join(layer, scores, order=["seq"])
    assert got.columns == ["region_id", "geometry", "activity_need_score"]
    assert rows(got) == [("36001", "g2", 3.0), ("Erie", "g1", 2.0), ("Kings", "g3", None)]


# --- whole run -------------------------------------------------------------------------------------


def test_run_on_a_workbook(spark):
    s = spark.createDataFrame([("Albany", 4.0), ("albany", 1.0), ("Grand Total", 5.0)], "county string, supply double")
    run = score_regions(wide(spark), s, activity="park")
    got = {r.region_id: (r.demand_value, r.need_score) for r in run.need_table.collect()}
    assert got == {"Albany": (0.25, 6.25), "albany": (0.25, 25.0), "Grand Total": (0.25, 5.0)}
    assert rows(run.activity_metrics, "region_id", "activity", "gap") == [("ALBANY", "Camping", -2.0), ("ALBANY", "Park", -3.0), ("ALBANY", "Walking/Jogging", -2.0)]
    with pytest.raises(ValueError):
        score_regions(wide(spark), s, activity="Polo")


def test_run_without_normalising_and_without_supply(spark):
    run = score_regions(wide(spark), normalize=False)
    assert rows(run.need_table, "region_id", "demand_value", "supply_value") == [("ALBANY", 8.0, 1.0), ("BRONX", 8.0, 1.0)]
    assert run.activity_metrics is None and run.layer is None


def test_run_repeated_supply_pairs_on_request_only(spark):
    s = spark.createDataFrame([("a", 4.0), ("a", 1.0)], "county string, supply double")
    assert sorted(r.supply_value for r in score_regions(wide(spark), s).need_table.collect()) == [1.0, 4.0]
    assert score_regions(wide(spark), s, pair_repeats=True).need_table.count() == 4
    run = score_regions(wide(spark), s, dedupe_supply="sum")
    assert set(r.supply_value for r in run.need_table.collect()) == {5.0}


def test_run_on_a_table_matches_regions(spark):
    run = score_regions(demand(spark, ("a", 3.0), ("b", 1.0), (None, 7.0)), supply(spark, ("a", 1.0), ("c", 1.0)))
    assert rows(run.need_table, "region_id", "need_score") == [("a", 300.0), ("b", None), ("c", 0.0)]
    assert [r.region_id for r in run.improvement.collect()] == ["a", "b"]
    alone = score_regions(demand(spark, ("a", 3.0)))
    assert rows(alone.need_table, "supply_value") == [(1.0,)]


def test_scoring_layers_together_equals_scoring_them_alone(spark):
    layers = "layer string, region_id string"
    d = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0), ("y", "a", 5.0)], f"{layers}, demand_value double")
    s = spark.createDataFrame([("x", "a", 4.0), ("y", "a", 0.0), ("y", "c", 2.0)], f"{layers}, supply_value double")
    both = R.need_table(d, s, ["layer"])
    for layer in ("x", "y"):
        alone = R.need_table(d.filter(F.col("layer") == layer).drop("layer"), s.filter(F.col("layer") == layer).drop("layer"))
        assert rows(both.filter(F.col("layer") == layer).drop("layer")) == rows(alone)


def test_clean_wide_and_index(spark):
    cleaned = K.clean_demand_wide(wide(spark), ACTIVITIES)
    assert ("BRONX", 0.0, 0.0, 0.0) in rows(cleaned)
    kept = K.clean_demand_wide(wide(spark), ACTIVITIES, clip_negative=False, standardize=False)
    assert kept.columns == wide(spark).columns and ("BRONX", 0.0, 0.0, -1.0) in rows(kept)
    index = spark.createDataFrame([(" Erie ", 0.2, 12, "a"), ("Kings", None, 5, "b")], "`Origin County` string, `Park-Index` double, n int, note string")
    assert rows(K.clean_index(index)) == [("Erie", 1.0, 10.0, "a"), ("Kings", None, 5.0, "b")]
    text = spark.createDataFrame([("Erie", "11"), ("Kings", "x")], "county string, score string")
    assert rows(K.clean_index(text)) == [("Erie", 10.0), ("Kings", None)]
