"""Region x activity metrics, activity rankings, summary statistics, class breaks and layer joins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N
from regional_balance.operators.score import keep_last

SUPERSEDED_LAYER_COLUMNS = ("need_score", "need_class", "priority_rank", "demand_value", "supply_value")


def _pair(per_activity: DataFrame, supply: DataFrame, by: Sequence[str], activities: Iterable[str] | None) -> DataFrame:
    """Equi-join on activity. Activity demand has one row per activity and group. With the ``activities`` listed and no
    groups that is made sure of, a repeated activity being an error, so its size is that of the list and it is broadcast;
    otherwise adaptive execution decides."""
    S.require(per_activity, *by, "activity", "demand_value", what="activity demand")
    S.require(supply, *by, "region_id", "activity", "supply_value", what="activity supply")
    demand = per_activity.select(*by, "activity", "demand_value")
    if activities is not None:
        activities = list(dict.fromkeys(activities))
        demand = demand.filter(F.col("activity").isin(*activities))
        if activities and not by:
            demand = F.broadcast(_one_row_each(demand, activities))
    return supply.join(demand, [*by, "activity"], "inner")


def _one_row_each(demand: DataFrame, activities: Sequence[str]) -> DataFrame:
    """(activity, demand_value), each listed activity once. All are folded into one row: no exchange is keyed by the few activities."""
    kind = demand.schema["activity"].dataType
    folds, entries = [], []
    for i, activity in enumerate(activities):
        own = F.col("activity") == activity
        folds += [F.count(F.when(own, 1)).alias(f"_n_{i}"), F.max(F.when(own, F.col("demand_value"))).alias(f"_value_{i}")]
        entry = [F.lit(activity).cast(kind).alias("activity"), F.col(f"_n_{i}").alias("_n"), F.col(f"_value_{i}").alias("demand_value")]
        entries.append(F.struct(*entry))
    folded = demand.agg(*folds).select(F.inline(F.array(*entries))).filter("_n > 0")
    twice = F.raise_error(F.concat(F.lit("activity demand has more than one row for "), F.coalesce("activity", F.lit("a missing activity"))))
    return folded.select("activity", F.when(F.col("_n") == 1, F.col("demand_value")).otherwise(twice.cast("double")).alias("demand_value"))


def activity_metrics(
    per_activity: DataFrame,
    supply: DataFrame,
    by: Sequence[str] = (),
    params: S.ScoreParams = S.ScoreParams(),
    activities: Iterable[str] | None = None,
) -> DataFrame:
    """Gap, supply/demand ratio and need score of every supply region and activity."""
    d, s = F.col("demand_value"), F.col("supply_value")
    return _pair(per_activity, supply, by, activities).select(
        *by,
        "region_id",
        "activity",
        "demand_value",
        "supply_value",
        (d - s).alias("gap"),
        C.supply_demand_ratio(d, s).alias("supply_demand_ratio"),
        C.need_score(d, s, params.scale).alias("need_score"),
    )


def activity_scores(
    per_activity: DataFrame,
    supply: DataFrame,
    activity: str | None = None,
    by: Sequence[str] = (),
    params: S.ScoreParams = S.ScoreParams(),
    activities: Iterable[str] | None = None,
) -> DataFrame:
    """Ranking table (by..., activity, Region, activity_demand, ActivityNeedScore), all activities at once.

    An activity that the demand table does not have gives no rows.
    """
    if activity is not None:
        supply = supply.filter(F.col("activity") == activity)
        activities = [activity]
    rows = _pair(per_activity, supply, by, activities).filter((F.col("region_id") != "") & ~C.is_summary_row(F.col("region_id")))
    return rows.select(
        *by,
        "activity",
        F.col("region_id").alias("Region"),
        F.col("demand_value").alias("activity_demand"),
        C.need_score(F.col("demand_value"), F.col("supply_value"), params.scale).alias("ActivityNeedScore"),
    )


def observed(scores: DataFrame, score: str = "ActivityNeedScore") -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that holds the counts of ``row_stats`` once they have been written or collected.

    The counts are gathered while the result itself is computed, so they cost no job. They are those of the first action on the
    frame that is returned; ``row_stats`` is for counts by group, or apart from any action.
    """
    counts = Observation()
    rows = F.count(F.lit(1))
    named = [rows.alias("supply_rows"), rows.alias("matched_rows"), F.count(score).alias("scored_rows")]
    return scores.observe(counts, *named), counts


def row_stats(scores: DataFrame, score: str = "ActivityNeedScore", by: Sequence[str] = ()) -> DataFrame:
    """Supply rows, rows matched to demand (all of them) and rows with a score.

    A query of its own; ``observed`` gathers the same while a result is written.
    """
    rows = F.count(F.lit(1))
    return scores.groupBy(*by).agg(rows.alias("supply_rows"), rows.alias("matched_rows"), F.count(score).alias("scored_rows"))


def display_rows(scores: DataFrame) -> DataFrame:
    """Text form of a ranking: region cut to 20 characters, score to 3 (list) and 6 (tooltip) decimals."""
    score = F.col("ActivityNeedScore")
    return scores.withColumns(
        {
            "region_text": C.region_text(F.col("Region")),
            "score_text": C.score_text(score),
            "tooltip_text": C.score_text(score, 6, "—"),
        }
    )


def summary(table: DataFrame, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Regions, regions needing improvement, mean and largest score and its region (the first id on ties)."""
    score, region = F.col("need_score"), F.col("region_id")
    distinct = F.approx_count_distinct(region) if approximate else F.count_distinct(region)
    largest = F.when(score.isNotNull(), F.struct(-score, region))
    return table.groupBy(*by).agg(
        distinct.alias("total_regions"),
        F.count_if(F.coalesce(F.col("need_class").contains(S.CLASS_NEEDS), F.lit(False))).alias("needs_improvement_count"),
        F.avg(score).alias("avg_need_score"),
        F.max(score).alias("max_need_score"),
        F.min_by(region, largest).alias("highest_need_region"),
    )


def class_breaks(scores: DataFrame, score: str = "need_score", bins: int = S.CLASS_BINS) -> DataFrame:
    """Equal-width class edges between the smallest and the largest score: (edges), one row."""
    lo = F.min(score)
    hi = F.max(score)
    top = F.when(hi <= lo, lo + F.lit(S.FLAT_RANGE_WIDTH)).otherwise(hi)
    limits = scores.agg(lo.alias("lo"), top.alias("hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(bins)
    inner = [F.col("lo") + F.lit(i) * step for i in range(bins)]
    return limits.select(F.when(F.col("lo").isNotNull(), F.array(*inner, F.col("hi"))).alias("edges"))


def with_class_bin(scores: DataFrame, score: str = "need_score", bins: int = S.CLASS_BINS) -> DataFrame:
    """Add the class (1..bins) each score falls in; the largest score belongs to the last class."""
    edges = class_breaks(scores, score, bins).scalar()
    out = scores.withColumn("_edges", edges)
    place = F.lit(1)
    for i in range(1, bins):
        place = place + (F.col(score) >= F.get("_edges", F.lit(i))).cast("int")
    return out.withColumn("score_bin", place).drop("_edges")


def layer_join(
    layer: DataFrame,
    scores: DataFrame,
    order: Sequence[str] | None = None,
    score: str = "ActivityNeedScore",
    out: str = "activity_need_score",
) -> DataFrame:
    """Scores on polygons by normalised region key; polygons without a score keep a missing one.

    Of scores with the same key the last by ``order`` is taken. Columns of an earlier scoring are dropped.
    """
    S.require(layer, "region_id", what="layer")
    S.require(scores, "Region", score, what="scores")
    order = list(order) if order is not None else [score]
    extra = [c for c in order if c != score]
    keyed = scores.select(C.merge_key(scores, "Region").alias("_join_key"), F.col(score).alias(out), *extra)
    last = keep_last(keyed, ["_join_key"], [out if c == score else c for c in order]).select("_join_key", out)
    kept = N.drop_present(layer, *SUPERSEDED_LAYER_COLUMNS, out)
    keyed_layer = kept.withColumn("_join_key", C.merge_key(layer, "region_id"))
    return keyed_layer.join(last, "_join_key", "left").select(*kept.columns, out)
