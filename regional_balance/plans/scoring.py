"""The batch run: demand and supply in, need table, improvement list, activity metrics and layer out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import names as N
from regional_balance.operators import demand as D
from regional_balance.operators import metrics as M
from regional_balance.operators import score as R
from regional_balance.operators import supply as U
from regional_balance.operators.clean import clean_demand_wide


@dataclass
class ScoredRegions:
    """Results, each built when first asked for. Only the need table may run jobs while it is built (its scores are
    checkpointed unless ``reproducible``); the activity metrics do not depend on it. ``skipped`` lists input files left out."""

    build: Callable[[], DataFrame]
    activity_metrics: DataFrame | None
    boundaries: DataFrame | None
    threshold: float
    skipped: DataFrame | None = None

    @cached_property
    def need_table(self) -> DataFrame:
        return self.build()

    @cached_property
    def improvement(self) -> DataFrame:
        return R.improvement_list(self.need_table, self.threshold)

    @cached_property
    def layer(self) -> DataFrame | None:
        return None if self.boundaries is None else R.attach_geometry(self.need_table, self.boundaries)


def score_regions(
    demand: DataFrame,
    supply: DataFrame | None = None,
    boundaries: DataFrame | None = None,
    activity: str | None = None,
    normalize: bool = True,
    threshold: float = S.IMPROVEMENT_THRESHOLD,
    by: Sequence[str] = (),
    activities: Iterable[str] = S.ACTIVITIES,
    params: S.ScoreParams = S.ScoreParams(),
    dedupe_supply: str | None = None,
    pair_repeats: bool = False,
    reproducible: bool = False,
) -> ScoredRegions:
    """Score every supply region.

    ``demand`` with a ``demand_value`` column is matched to supply by region. A wide activity table is not: it is
    reduced to one value (``activity``, or all activities; as a share of the total with ``normalize``) that
    every supply region gets, and it also gives the region x activity metrics. ``supply`` is any table with a
    region and a supply column, or None for a constant supply of 1. Rows without a region id are left out.

    A region with k supply rows gets k rows. ``pair_repeats`` joins the rows of a region with each other instead,
    which gives k x k of them. ``reproducible`` is that of ``need_table``.
    """
    by, activities = list(by), list(activities)
    direct = "demand_value" in demand.columns
    if not direct:
        demand = clean_demand_wide(demand, activities, clip_negative=False, standardize=False)

    if supply is not None:
        regions = U.tabular_supply(supply, by)
        unique = False
    elif direct:
        regions = U.supply_constant(demand, by=by)
        unique = False
    else:
        regions = U.supply_constant(D.demand_regions(demand, by), by=by)
        unique = True
    regions = regions.filter(F.col("region_id").isNotNull())

    metrics = None
    if direct:
        values = D.demand_from_table(demand, by=by)
    else:
        per_activity = D.activity_demand(demand, activities, by=by)
        known = N.activity_columns(demand, activities)
        scalar = D.scalar_demand(per_activity, activity, normalize, by, known)
        values = D.spread_demand(regions, scalar, by)
        if supply is not None and not pair_repeats:
            values = values.dropDuplicates([*by, "region_id"])
        if supply is not None:
            per_region = U.activity_supply(supply, activities, by)
            metrics = M.activity_metrics(per_activity, per_region, by, params, list(known))
    values = values.filter(F.col("region_id").isNotNull())

    def build() -> DataFrame:
        return R.need_table(values, regions, by, params, keys_unique=unique, dedupe_supply=dedupe_supply, reproducible=reproducible)

    return ScoredRegions(build, metrics, boundaries, threshold)
