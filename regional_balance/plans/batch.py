"""The batch run on files: newest inputs by name and time, scored and, if asked, exported."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N
from regional_balance.operators import layout as L
from regional_balance.plans.scoring import ScoredRegions, score_regions
from regional_balance.sources import discovery, features, tabular

#: What the loaders below read; other kinds of a role's files are converted first.
READABLE = (".csv", ".parquet", ".geojson", ".json")


def newest_inputs(spark: SparkSession, raw: str, top: str | None = None, max_depth: int | None = S.MAX_LISTING_DEPTH) -> dict[str, str]:
    """Newest demand and supply file that can be read here: at most one path per role comes back to the driver."""
    found = discovery.candidate_files(discovery.list_files(spark, raw, top, max_depth))
    readable = C.file_extension(F.col("path")).isin(*READABLE)
    latest = discovery.latest_per_role(found.filter(readable))
    return {r["role"]: r["path"] for r in latest.collect()}


def skipped_inputs(spark: SparkSession, raw: str, top: str | None = None, max_depth: int | None = S.MAX_LISTING_DEPTH) -> DataFrame:
    """(path, reason) of files with a role that a run does not consider: below the listing's depth, or of a kind to convert first."""
    named = discovery.candidate_files(discovery.list_files(spark, raw, top, max_depth))
    unread = named.filter(~C.file_extension(F.col("path")).isin(*READABLE)).select("path", F.lit("file type not read").alias("reason"))
    if max_depth is None:
        return unread
    deep = discovery.candidate_files(discovery.too_deep(spark, raw, max_depth))
    return unread.unionByName(deep.select("path", F.lit("below the listing depth").alias("reason")))


def load_demand(spark: SparkSession, path: str, rules: L.LayoutRules = L.RULES) -> DataFrame:
    """A demand CSV: a table of region_id and demand_value, or a sheet with the activity columns."""
    if not path.lower().endswith(".csv"):
        raise ValueError(f"unsupported demand file type, save the sheet as CSV: {path}")
    table = tabular.read_csv(spark, path)
    if all(N.find_by_name(table.columns, [c]) for c in ("region_id", "demand_value")):
        return tabular.demand_from_csv(table)
    cells = L.cells_from_csv(spark, path)
    if not L.unresolved_files(cells, rules=rules).isEmpty():
        raise ValueError(f"no demand layout found in {path}: neither title rows and standard columns nor a header row")
    return L.resolve_wide_layout(cells, rules=rules).drop("file", "row")


def load_supply(spark: SparkSession, path: str) -> DataFrame:
    """Supply as scoring wants it: the raw table of a tabular file, so that activity columns stay available."""
    lower = path.lower()
    if lower.endswith(".csv"):
        return tabular.read_csv(spark, path, infer=True)
    if lower.endswith(".parquet"):
        return spark.read.parquet(path)
    return tabular.read_supply(spark, path)


def score_files(
    spark: SparkSession,
    raw: str | None = None,
    top: str | None = None,
    demand: str | None = None,
    supply: str | None = None,
    boundaries: str | None = None,
    export_to: str | None = None,
    threshold: float = S.IMPROVEMENT_THRESHOLD,
    max_depth: int | None = S.MAX_LISTING_DEPTH,
    rules: L.LayoutRules = L.RULES,
    **options,
) -> ScoredRegions:
    """Score files. Paths that are not given are the newest of their role under ``raw`` and ``top``.

    ``max_depth`` bounds the listing (None: no bound) and ``rules`` say where a sheet's header may be; ``skipped`` of the result
    names files that were left out. Without any supply file each region gets a supply of 1. ``options`` go to ``score_regions``.
    """
    listed = raw is not None and (demand is None or supply is None)
    found = newest_inputs(spark, raw, top, max_depth) if listed else {}
    demand, supply = demand or found.get("demand"), supply or found.get("supply")
    if demand is None:
        raise FileNotFoundError("no demand file: give one, or a folder with a file named like d8 or demand")
    bounds = features.boundary_features(features.read_features(spark, boundaries)) if boundaries else None
    results = score_regions(
        load_demand(spark, demand, rules),
        load_supply(spark, supply) if supply else None,
        bounds,
        threshold=threshold,
        **options,
    )
    results.skipped = skipped_inputs(spark, raw, top, max_depth) if listed else None
    if export_to is not None:
        from regional_balance.sinks.writers import export_results

        export_results(results, export_to, threshold)
    return results


def has_scores(results: ScoredRegions) -> bool:
    """Whether any region has a score; a run whose supply is all zero or missing has none."""
    return not results.need_table.filter(F.col("need_score").isNotNull()).isEmpty()
