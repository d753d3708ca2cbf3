"""Cleaning of wide tables, column by column, in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N


def clean_demand_wide(
    df: DataFrame,
    activity_columns: Sequence[str] | None = None,
    clip_negative: bool = True,
    standardize: bool = True,
) -> DataFrame:
    """Upper-case region ids; activity columns numeric, missing as zero, negatives clipped if asked.

    ``activity_columns`` None means every column but the region; names are matched by spelling key.
    """
    if standardize:
        df = N.standardize_columns(df)
    S.require(df, "region_id", what="wide demand")
    others = [c for c in df.columns if c != "region_id"]
    if activity_columns is None:
        chosen = set(others)
    else:
        chosen = {N.find_label_column(others, a) for a in activity_columns} - {None}

    def cleaned(name: str):
        value = C.filled(C.number(df, name).cast("double"))
        return C.clipped(value, lower=0.0) if clip_negative else value

    return df.select(
        *[
            C.upper_id(F.col("region_id")).alias("region_id")
            if c == "region_id"
            else cleaned(c).alias(c)
            if c in chosen
            else N.quoted(c)
            for c in df.columns
        ]
    )


def clean_index(
    df: DataFrame,
    low: float = S.INDEX_MIN,
    high: float = S.INDEX_MAX,
    score_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Index table: the first column is the region unless one is named so; scores clipped, missing kept."""
    df = N.standardize_columns(df)
    if "region_id" not in df.columns:
        df = df.withColumnRenamed(df.columns[0], "region_id")
    others = [c for c in df.columns if c != "region_id"]
    if score_columns is None:
        numeric = [c for c in others if isinstance(df.schema[c].dataType, T.NumericType)]
        score_columns = numeric or others
    chosen = set(score_columns)
    return df.select(
        *[
            C.strip(F.col("region_id").cast("string")).alias("region_id")
            if c == "region_id"
            else C.clipped(C.number(df, c).cast("double"), low, high).alias(c)
            if c in chosen
            else N.quoted(c)
            for c in df.columns
        ]
    )
