"""Activity rankings and their map layer, for one activity or all of them in one query."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from regional_balance import schema as S
from regional_balance.functions import names as N
from regional_balance.operators import demand as D
from regional_balance.operators import metrics as M
from regional_balance.operators import score as R
from regional_balance.operators import spatial as X
from regional_balance.operators import supply as U


@dataclass(frozen=True)
class Ranking:
    """``rows`` sorted for display, ``stats`` their counts in one row, ``layer`` for mapping."""

    rows: DataFrame
    stats: DataFrame
    layer: DataFrame | None


def activity_scores_table(
    demand_wide: DataFrame,
    supply: DataFrame,
    activity: str | None = None,
    activities: Iterable[str] = S.ACTIVITIES,
) -> DataFrame:
    """Scores of supply regions by activity, straight from a wide demand table and a tabular supply."""
    activities = [activity] if activity is not None else list(activities)
    known = N.activity_columns(demand_wide, activities)
    per_activity = D.activity_demand(demand_wide, activities)
    per_region = U.activity_supply(supply, activities)
    return M.activity_scores(per_activity, per_region, activity, activities=list(known))


def activity_ranking(
    demand_wide: DataFrame,
    supply: DataFrame,
    activity: str,
    boundaries: DataFrame | None = None,
    descending: bool = True,
    limit: int | None = None,
) -> Ranking:
    """Regions by the score of one activity, missing scores last in either direction, and their polygons with
    score, class and tooltip text in longitude/latitude."""
    scores = activity_scores_table(demand_wide, supply, activity).drop("activity")
    rows = R.top_regions(M.display_rows(scores), limit, descending, "ActivityNeedScore", "Region")
    layer = None
    if boundaries is not None:
        shapes = X.drop_missing_geometry(M.layer_join(boundaries, scores))
        layer = M.with_class_bin(X.to_crs(shapes, S.SRID_LONLAT), "activity_need_score")
    return Ranking(rows, M.row_stats(scores), layer)
