from pyspark.sql import functions as F

from regional_balance.operators import validate as V


def reasons(checked, key):
    return {r[key]: r.reasons for r in checked.checked.select(key, "reasons").collect()}


def test_survey(spark):
    data = [("ok", "10", "5"), ("zero", "0", "0"), ("frac", "1.5", "1"), ("neg", "-1", "-2"), ("over", "3", "4"), ("none", None, "1"), (None, "5", "1"), ("text", "many", "x")]
    got = V.clean_survey(spark.createDataFrame(data, "`Region Code` string, Population string, Participants string"), "region_code")
    why = reasons(got, "region_id")
    assert why["ok"] == why["zero"] == []
    assert why["frac"] == why["none"] == ["population not a count"]
    assert why["neg"] == why["text"] == ["population not a count", "participants not a count"] or why["neg"][:2] == ["population not a count", "participants not a count"]
    assert why["over"] == ["participants exceed population"]
    assert why[None] == ["region_id missing"]
    assert got.valid.schema.simpleString() == "struct<region_id:string,population:bigint,participants:bigint>"
    assert got.valid.count() + got.rejects.count() == len(data)
    assert {r.reason: r.n for r in got.reject_counts().collect()}["region_id missing"] == 1


def test_numeric_ids_are_accepted(spark):
    got = V.clean_survey(spark.createDataFrame([(36001, 10, 5)], "region_id long, population long, participants long"))
    assert [tuple(r) for r in got.valid.collect()] == [("36001", 10, 5)]


def test_census_optionals_may_be_absent_or_missing(spark):
    got = V.clean_census(spark.createDataFrame([("a", 10, "5"), ("b", -1, None), ("c", 1, "n/a")], "region_id string, total_population long, median_income string"))
    assert reasons(got, "region_id") == {"a": [], "b": ["total_population not a count"], "c": ["median_income not a number"]}
    assert [r.poverty_rate for r in got.valid.collect()] == [None]


def test_facilities_keep_repeats_and_other_columns(spark):
    data = [("1", "a", 5.0, "g1"), ("1", "a", 6.0, "g2"), (None, "b", 1.0, "g3"), ("3", None, float("nan"), "g4")]
    got = V.clean_facilities(spark.createDataFrame(data, "`Facility ID` string, area string, capacity double, geometry string"), "area")
    assert sorted(r.geometry for r in got.valid.collect()) == ["g1", "g2", "g4"]
    assert {r.facility_type for r in got.valid.collect()} == {"unknown"}
    assert reasons(got, "facility_id")[None] == ["facility_id missing"]
    assert [r.capacity for r in got.valid.filter("geometry = 'g4'").collect()] == [None]


def test_minted_ids_come_from_content(spark):
    rows = spark.createDataFrame([(float(i), "p") for i in range(20)], "capacity double, kind string")
    ids = {r.capacity: r.facility_id for r in V.clean_facilities(rows).valid.collect()}
    again = {r.capacity: r.facility_id for r in V.clean_facilities(rows.orderBy(F.desc("capacity")).repartition(3)).valid.collect()}
    assert ids == again and len(set(ids.values())) == 20 and all(v.startswith("fac_") for v in ids.values())


def test_boundaries(spark):
    got = V.clean_boundaries(spark.createDataFrame([("a", "g"), (None, "h")], "NAME_2 string, geometry string"), "name_2")
    assert reasons(got, "region_id") == {"a": [], None: ["region_id missing"]}
    assert got.valid.columns == ["geometry", "region_id", "name"]


def test_demand(spark):
    data = [(" a ", "Park", "1"), ("", "Park", "1"), ("b", " ", "1"), ("c", "Park", "-1"), ("d", "Park", "x"), (None, "Park", "2")]
    got = V.clean_demand_long(spark.createDataFrame(data, "`Region ID` string, Activity string, Demand string"))
    assert reasons(got, "region_id") == {"A": [], "": ["region_id empty"], "B": ["activity empty"], "C": ["demand negative"], "D": [], None: ["region_id empty"]}
    assert {r.region_id: r.demand for r in got.valid.collect()} == {"A": 1.0, "D": 0.0}
