"""Survey, census, facilities and boundaries brought to one geography, and scored from there."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.operators import demand as D
from regional_balance.operators import score as R
from regional_balance.operators import spatial as G
from regional_balance.operators import supply as U


@dataclass(frozen=True)
class Aligned:
    survey: DataFrame
    census: DataFrame
    facilities: DataFrame
    boundaries: DataFrame

    def frames(self) -> dict[str, DataFrame]:
        return {"survey": self.survey, "census": self.census, "facilities": self.facilities, "boundaries": self.boundaries}


def align_to_geography(
    survey: DataFrame,
    census: DataFrame,
    facilities: DataFrame,
    boundaries: DataFrame,
    **options,
) -> Aligned:
    """Facilities without a region column get their region by location; those left without one are dropped.

    ``sinks.writers.write_aligned`` keeps the four tables.
    """
    bounds = boundaries.select("region_id", "geometry")
    if "region_id" not in facilities.columns:
        facilities = G.assign_regions(facilities, bounds, **options)
    return Aligned(survey, census, facilities.filter(F.col("region_id").isNotNull()), bounds)


def score_aligned(
    aligned: Aligned,
    use_rate: bool = True,
    use_capacity: bool = True,
    params: S.ScoreParams = S.ScoreParams(),
) -> tuple[DataFrame, DataFrame]:
    """Need table from survey participation and facility supply, and the same with region polygons."""
    demand = D.demand_from_survey(aligned.survey, use_rate)
    supply = U.supply_from_facilities(aligned.facilities, use_capacity)
    table = R.need_table(demand, supply, params=params)
    return table, R.attach_geometry(table, aligned.boundaries)
