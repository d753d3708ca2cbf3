"""Need score: demand joined to supply, scored, classified, ranked, and the lists drawn from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.operators.rank import add_rank
from regional_balance.session import settle


def combine(demand: DataFrame, supply: DataFrame, by: Sequence[str] = (), keys_unique: bool = False) -> DataFrame:
    """Full outer join of demand and supply on region id (and ``by``); repeated keys multiply.

    Spark cannot split a skewed partition of a full outer join. Unless the caller knows that keys do not
    repeat, the join is therefore written as its inner part, where adaptive execution splits both sides, and
    the two unmatched parts, each an anti-join against distinct keys.
    """
    keys = [*by, "region_id"]
    S.require(demand, *keys, "demand_value", what="demand")
    S.require(supply, *keys, "supply_value", what="supply")
    d = demand.select(*keys, C.number(demand, "demand_value").cast("double").alias("demand_value"))
    s = supply.select(*keys, C.number(supply, "supply_value").cast("double").alias("supply_value"))
    if keys_unique:
        joined = d.join(s, keys, "full")
    else:
        missing = F.lit(None).cast("double")
        both = d.join(s, keys, "inner")
        only_demand = d.join(s.select(*keys).distinct(), keys, "left_anti").withColumn("supply_value", missing)
        only_supply = s.join(d.select(*keys).distinct(), keys, "left_anti").withColumn("demand_value", missing)
        joined = both.unionByName(only_demand).unionByName(only_supply)
    return joined.withColumn("demand_value", C.filled(F.col("demand_value")))


def classify(df: DataFrame, params: S.ScoreParams = S.ScoreParams()) -> DataFrame:
    return df.withColumn("need_class", C.need_class(F.col("need_score"), F.col("supply_value"), params))


def need_table(
    demand: DataFrame,
    supply: DataFrame,
    by: Sequence[str] = (),
    params: S.ScoreParams = S.ScoreParams(),
    keys_unique: bool = False,
    nonpositive_supply: str = "keep",
    dedupe_supply: str | None = None,
    reproducible: bool = False,
) -> DataFrame:
    """(by..., region_id, demand_value, supply_value, need_score, need_class, priority_rank).

    ``keys_unique``        both inputs hold one row per key, as the aggregates of this package do.
    ``nonpositive_supply`` ``keep``: zero supply has no score and no class; ``null``: it counts as no supply.
    ``dedupe_supply``      ``sum`` adds up repeated supply rows before the join.
    ``reproducible``       the input values do not come from floating sums (decimals, counts, plain columns). The
                           score table is otherwise computed and checkpointed once, here, and ranked from there.
    """
    keys = [*by, "region_id"]
    if dedupe_supply == "sum":
        supply = supply.groupBy(*keys).agg(F.sum(C.number(supply, "supply_value")).cast("double").alias("supply_value"))
    elif dedupe_supply is not None:
        raise ValueError(f"dedupe_supply must be None or 'sum', not {dedupe_supply!r}")
    joined = combine(demand, supply, by, keys_unique)
    if nonpositive_supply == "null":
        joined = joined.withColumn("supply_value", F.when(F.col("supply_value") > 0, F.col("supply_value")))
    elif nonpositive_supply != "keep":
        raise ValueError(f"nonpositive_supply must be 'keep' or 'null', not {nonpositive_supply!r}")
    scored = joined.select(
        *keys,
        "demand_value",
        "supply_value",
        C.need_score(F.col("demand_value"), F.col("supply_value"), params.scale).alias("need_score"),
    )
    classified = classify(scored, params)
    return add_rank(classified if reproducible else settle(classified), "need_score", by)


def attach_geometry(table: DataFrame, boundaries: DataFrame, rank_after_join: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Left join of a need table to region polygons on the raw region id.

    Repeated boundary ids repeat rows. Ranks were given before the join and stay as they are;
    ``rank_after_join`` ranks the joined rows instead.
    """
    S.require(boundaries, "region_id", "geometry", what="boundaries")
    joined = table.join(boundaries.select("region_id", "geometry"), "region_id", "left")
    joined = joined.select(*table.columns, "geometry")
    return add_rank(joined, "need_score", by) if rank_after_join else joined


def improvement_rows(table: DataFrame, threshold: float = S.IMPROVEMENT_THRESHOLD) -> DataFrame:
    """Rows above the threshold or in a needs-improvement class, unsorted."""
    return table.filter(C.needs_improvement(F.col("need_score"), F.col("need_class"), threshold))


def improvement_list(table: DataFrame, threshold: float = S.IMPROVEMENT_THRESHOLD) -> DataFrame:
    """The same rows by falling score, missing scores last, equal scores by region id."""
    return improvement_rows(table, threshold).orderBy(F.col("need_score").desc_nulls_last(), "region_id")


def top_regions(
    scores: DataFrame,
    n: int | None = None,
    descending: bool = True,
    score: str = "need_score",
    region: str = "region_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """First ``n`` rows by score, missing last in both directions, equal scores by region; per ``by`` group.

    With ``by``, Spark's group limit keeps at most ``n`` rows per task and group before the shuffle.
    """
    c = F.col(score)
    order = [c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col(region).asc()]
    if not by:
        ordered = scores.orderBy(*order)
        return ordered if n is None else ordered.limit(n)
    if n is None:
        return scores.orderBy(*by, *order)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return scores.withColumn("place", place).filter(F.col("place") <= n)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; partial aggregates keep one candidate per task and key."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col(f"_last.{c}") for c in df.columns])
