"""Queries over the driver tables: each operator of the engine on whole tables, with its SQL equivalent."""

from workload.registry import ORACLES, QUERIES
from workload import demand_supply, files, quality, scores, spatial, stored  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
