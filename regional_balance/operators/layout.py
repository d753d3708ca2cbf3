"""Wide demand tables inside sheet grids, found for any number of files in one job.

Input are cells: (file, sheet_idx, sheet, row, col, value), rows and columns counted from zero. Cells can come
from any reader; ``cells_from_csv`` makes them from header-less CSV sheets. No step gathers a sheet: header
tests are conditional minima per row, and tables are read out by conditional maxima per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N

FIXED, HEADER = 0, 1
_SHEET = ["file", "sheet_idx"]


def cells_from_csv(spark: SparkSession, path: str, sheet: str = "Sheet1") -> DataFrame:
    """Cells of header-less CSV sheets, one sheet per file. Quoted fields may hold commas but not line breaks.

    A sheet is read as one document, since only that keeps line numbers; these are hand-made tables, not bulk data.
    """
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = text.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("row", "line"))
    lines = lines.filter(F.trim("line") != "")
    fields = F.split("line", r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    cells = lines.select("file", "row", F.posexplode(fields).alias("col", "raw"))
    unquoted = F.regexp_replace(F.regexp_replace("raw", r'^\s*"(.*)"\s*$', "$1"), '""', '"')
    value = F.when(C.strip(unquoted) != "", unquoted)
    return cells.select(
        "file", F.lit(0).alias("sheet_idx"), F.lit(sheet).alias("sheet"), "row", "col", value.alias("value")
    )


def sheet_preference(sheet: Column, preferred: Sequence[str] = S.PREFERRED_SHEETS) -> Column:
    """Position of a sheet name in the preferred list; other sheets come after all of them."""
    name = F.lower(C.strip(sheet))
    rank = F.lit(len(preferred))
    for i, wanted in reversed(list(enumerate(preferred))):
        rank = F.when(name == wanted, F.lit(i)).otherwise(rank)
    return F.coalesce(rank, F.lit(len(preferred)))


def _has_value(c: Column) -> Column:
    return c.isNotNull() & (F.lower(C.strip(c)) != "nan") & (C.strip(c) != "")


def _column_profile(cells: DataFrame) -> DataFrame:
    """Per sheet and column: last row, last row that is not missing, last row that holds text. One pass over all cells."""
    return cells.groupBy(*_SHEET, "sheet", "col").agg(
        F.max("row").alias("last_row"),
        F.max(F.when(F.col("value").isNotNull(), F.col("row"))).alias("last_present"),
        F.max(F.when(_has_value(F.col("value")), F.col("row"))).alias("last_text"),
    )


@dataclass(frozen=True)
class LayoutRules:
    """``header_rows``: rows from the top that may hold the header, None for all. ``title_rows`` and ``min_rows``: those
    above a table in standard order, and the least it has in all."""

    header_rows: int | None = S.HEADER_SEARCH_ROWS
    title_rows: int = S.FIXED_LAYOUT_TITLE_ROWS
    min_rows: int = S.FIXED_LAYOUT_MIN_ROWS


RULES = LayoutRules()


def _fixed_layouts(profile: DataFrame, activities: Sequence[str], rules: LayoutRules) -> DataFrame:
    """Sheets with title rows, then index, region and activity columns in standard order."""
    width = 2 + len(activities)
    in_region = (F.col("col") == 1) & (F.col("last_present") >= rules.title_rows)
    shape = profile.groupBy(*_SHEET, "sheet").agg(
        (F.max("last_row") + 1).alias("rows"),
        (F.max("col") + 1).alias("cols"),
        F.max(F.coalesce(in_region, F.lit(False))).alias("has_region"),
    )
    fits = (F.col("cols") >= width) & (F.col("rows") >= rules.min_rows) & F.col("has_region")
    return shape.filter(fits).select(
        *_SHEET,
        "sheet",
        F.lit(FIXED).alias("layout"),
        F.lit(rules.title_rows - 1).alias("header_row"),
        F.lit(1).alias("region_col"),
        F.array(*[F.lit(i) for i in range(2, width)]).alias("activity_cols"),
    )


def _header_layouts(cells: DataFrame, profile: DataFrame, activities: Sequence[str], rules: LayoutRules) -> DataFrame:
    """Rows among the first ones that name a region column and every activity."""
    head = cells.filter(_has_value(F.col("value")))
    if rules.header_rows is not None:
        head = head.filter(F.col("row") < rules.header_rows)
    row = [*_SHEET, "sheet", "row"]
    # Of columns with the very same header only the first counts.
    named = head.groupBy(*row, C.strip(F.col("value")).alias("name")).agg(F.min("col").alias("col"))
    lower, key, col = F.lower("name"), C.label_key(F.col("name")), F.col("col")
    spelled = {a: F.struct((lower != a.lower()).alias("by_key"), col.alias("col")) for a in activities}
    picks = [
        F.min(F.when((lower == a.lower()) | (key == N.name_key(a)), spelled[a])).alias(f"_a{i}")
        for i, a in enumerate(activities)
    ]
    regions = [F.max(F.when(lower == r, col)).alias(f"_r{i}") for i, r in enumerate(S.SHEET_REGION_NAMES)]
    activity_keys = [N.name_key(a) for a in activities]
    other = F.min(F.when(~key.isin(*activity_keys) & ~lower.startswith("unnamed"), col)).alias("_other")
    found = named.groupBy(*row).agg(*picks, *regions, other)
    region = F.coalesce(*[F.col(f"_r{i}") for i in range(len(S.SHEET_REGION_NAMES))], F.col("_other"))
    chosen = F.array(*[F.col(f"_a{i}.col") for i in range(len(activities))])
    complete = region.isNotNull()
    for i in range(len(activities)):
        complete = complete & F.col(f"_a{i}").isNotNull()
    layouts = found.filter(complete & ~F.array_contains(chosen, region)).select(
        *_SHEET,
        "sheet",
        F.lit(HEADER).alias("layout"),
        F.col("row").alias("header_row"),
        region.alias("region_col"),
        chosen.alias("activity_cols"),
    )
    # The region column must hold something below the header.
    below = profile.select(*_SHEET, F.col("col").alias("region_col"), "last_text")
    used = layouts.join(below, [*_SHEET, "region_col"], "inner").filter(F.col("last_text") > F.col("header_row"))
    return used.select(*layouts.columns)


def find_layouts(cells: DataFrame, activities: Sequence[str] = S.ACTIVITIES, rules: LayoutRules = RULES) -> DataFrame:
    """The layout to read each file by: fixed before header, preferred sheets first, upper header rows first."""
    activities = list(activities)
    profile = _column_profile(cells)
    every = _fixed_layouts(profile, activities, rules).unionByName(_header_layouts(cells, profile, activities, rules))
    order = F.struct("layout", sheet_preference(F.col("sheet")).alias("preference"), "sheet_idx", "header_row")
    best = F.min_by(F.struct("sheet_idx", "layout", "header_row", "region_col", "activity_cols"), order).alias("best")
    return every.groupBy("file").agg(best).select("file", "best.*")


def resolve_wide_layout(cells: DataFrame, activities: Sequence[str] = S.ACTIVITIES, rules: LayoutRules = RULES) -> DataFrame:
    """(file, row, region_id, one column per activity) of every file that has a layout.

    Region ids are upper-cased, values that are not numbers count as zero, rows without a region are left out.
    """
    activities = list(activities)
    layouts = find_layouts(cells, activities, rules)
    placed = cells.join(layouts, _SHEET, "inner").filter(F.col("row") > F.col("header_row"))
    at = F.col("col")
    values = [
        F.max(F.when(at == F.col("activity_cols")[i], F.col("value"))).alias(f"_a{i}") for i in range(len(activities))
    ]
    rows = placed.groupBy("file", "row").agg(
        F.max(F.when(at == F.col("region_col"), F.col("value"))).alias("_region"), *values
    )
    rows = rows.filter(_has_value(F.col("_region")))
    return rows.select(
        "file",
        "row",
        C.upper_id(F.col("_region")).alias("region_id"),
        *[C.filled(C.text_number(F.col(f"_a{i}"))).alias(a) for i, a in enumerate(activities)],
    )


def unresolved_files(cells: DataFrame, activities: Sequence[str] = S.ACTIVITIES, rules: LayoutRules = RULES) -> DataFrame:
    """Files without any layout, to be reported rather than dropped in silence."""
    return cells.select("file").distinct().join(find_layouts(cells, activities, rules).select("file"), "file", "left_anti")
