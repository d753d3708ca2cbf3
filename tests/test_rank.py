from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from regional_balance.operators.rank import _add_range, add_rank
from workload.registry import Tables


def expected(rows):
    out = []
    for group, score in rows:
        peers = [s for g, s in rows if g == group and s is not None]
        out.append((group, score, None if score is None else 1 + sum(s > score for s in peers)))
    return sorted(out, key=str)


scores = st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False), st.integers(-3, 3).map(float))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), scores), min_size=1, max_size=60), st.integers(1, 2))
def test_rank_equals_definition(spark, rows, steps):
    rows = [(g, s + 0.0 if s is not None else None) for g, s in rows]
    df = spark.createDataFrame(rows, "g string, need_score double")
    got = add_rank(df, by=["g"], steps=steps)
    assert sorted(((r.g, r.need_score, r.priority_rank) for r in got.collect()), key=str) == expected(rows)
    whole = [(None, s) for _, s in rows]
    got = add_rank(df.select("need_score"), steps=steps).collect()
    assert sorted(((None, r.need_score, r.priority_rank) for r in got), key=str) == expected(whole)


def test_rank_equals_window_on_driver_table(spark, sf):
    rows = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", F.nullif(F.col("l_quantity"), F.lit(7.0)).alias("need_score"))
    for by in ([], ["l_returnflag"]):
        w = Window.partitionBy(*by).orderBy(F.col("need_score").desc_nulls_last())
        want = rows.withColumn("priority_rank", F.when(F.col("need_score").isNotNull(), F.rank().over(w)).cast("long"))
        got = add_rank(rows, by=by)
        assert got.count() == rows.count()
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_rank_plan_has_no_window_over_everything(spark, sf, plan):
    rows = Tables(spark, sf).lineitem.select("l_orderkey", F.col("l_extendedprice").alias("need_score"))
    text = plan(add_rank(rows))
    windows = [line for line in text.splitlines() if "Window [" in line]
    # One window runs within ranges, the other over the few range totals; none orders the rows themselves.
    assert len(windows) == 2
    assert sum("windowspecdefinition(_range" in line and "need_score" in line for line in windows) == 1
    assert sum("need_score" not in line for line in windows) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_ranges_stay_few(spark, sf):
    rows = Tables(spark, sf).lineitem.select("l_extendedprice")
    counts = rows.groupBy("l_extendedprice").agg(F.count("*").alias("_n"))
    splits = F.lit([float(v) for v in range(0, 100000, 400)][:255])
    ranged = _add_range(counts, splits, "l_extendedprice", 2)
    want = F.least(F.ceil(F.col("l_extendedprice") / 400), F.lit(250)).cast("int")
    assert ranged.filter(F.col("_range") != want).isEmpty()
    assert ranged.select("_range").distinct().count() <= 256


def test_rank_replaces_an_earlier_rank(spark):
    df = spark.createDataFrame([(1.0, 9), (2.0, 9)], "need_score double, priority_rank long")
    assert sorted((r.need_score, r.priority_rank) for r in add_rank(df).collect()) == [(1.0, 2), (2.0, 1)]


