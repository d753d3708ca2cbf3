"""Regional balance: need scoring of regional supply against regional demand, as Spark jobs."""

from regional_balance.plans.scoring import ScoredRegions, score_regions

__all__ = ["ScoredRegions", "score_regions"]
