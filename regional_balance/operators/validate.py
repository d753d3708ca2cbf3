"""Row contracts. Each gives the valid rows, typed, and the rejected rows with all their reasons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance import schema as S
from regional_balance.functions import columns as C
from regional_balance.functions import names as N


_RAW = "raw_values"


@dataclass(frozen=True)
class Validated:
    """``checked`` carries every row with ``reasons``; ``valid`` and ``rejects`` are its two filters. Where values were typed,
    rejects also have them as they came, in the map ``raw_values``."""

    checked: DataFrame

    @property
    def valid(self) -> DataFrame:
        return self.checked.filter(F.size("reasons") == 0).drop("reasons", _RAW)

    @property
    def rejects(self) -> DataFrame:
        return self.checked.filter(F.size("reasons") > 0)

    def reject_counts(self) -> DataFrame:
        return self.rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def check(df: DataFrame, rules: Mapping[str, Column]) -> Validated:
    """``rules``: reason -> condition that must hold; an unknown condition counts as broken."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in rules.items()]
    return Validated(df.withColumn("reasons", F.array_compact(F.array(*broken))))


def _typed(df: DataFrame, typed: Mapping[str, Column], rules: Mapping[str, Column], extra: Sequence[str] = ()) -> Validated:
    """Coerce first, then check: rules are written over the typed columns, so each value is parsed once.

    Typed columns whose name starts with ``_`` only serve the rules.
    """
    came = [x for n in typed if n in df.columns for x in (F.lit(n), N.quoted(n).cast("string"))]
    raw = F.create_map(*came) if came else F.lit(None).cast("map<string,string>")
    coerced = df.select(*[c for c in extra if c != _RAW], *[c.alias(n) for n, c in typed.items()], raw.alias(_RAW))
    checked = check(coerced, rules).checked
    return Validated(checked.drop(*[n for n in typed if n.startswith("_")]))


def _optional_number(df: DataFrame, name: str) -> dict[str, Column]:
    """Typed value of an optional number, and whether the raw column holds anything."""
    if name not in df.columns:
        return {name: F.lit(None).cast("double"), f"_has_{name}": F.lit(False)}
    text = C.strip(N.quoted(name).cast("string"))
    present = text.isNotNull() & (F.lower(text) != "nan")
    return {name: C.number(df, name).cast("double"), f"_has_{name}": present}


def _is_number_or_missing(name: str) -> Column:
    return F.col(name).isNotNull() | ~F.col(f"_has_{name}")


def _optional_text(df: DataFrame, name: str) -> Column:
    return N.quoted(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _prepare(df: DataFrame, region_col: str | None) -> DataFrame:
    df = N.standardize_columns(df)
    if region_col and region_col in df.columns and region_col != "region_id":
        df = df.drop("region_id").withColumnRenamed(region_col, "region_id")
    return df


def clean_survey(df: DataFrame, region_col: str = "region_id") -> Validated:
    """region_id, population >= 0, participants >= 0 and not above the population; whole numbers only."""
    df = _prepare(df, region_col)
    S.require(df, "region_id", "population", "participants", what="survey")
    return _typed(
        df,
        {
            "region_id": F.col("region_id").cast("string"),
            "population": C.whole_number(df, "population"),
            "participants": C.whole_number(df, "participants"),
        },
        {
            "region_id missing": F.col("region_id").isNotNull(),
            "population not a count": F.col("population") >= 0,
            "participants not a count": F.col("participants") >= 0,
            "participants exceed population": F.coalesce(F.col("participants") <= F.col("population"), F.lit(True)),
        },
    )


def clean_census(df: DataFrame, region_col: str = "region_id") -> Validated:
    """region_id, total_population >= 0; median_income and poverty_rate optional."""
    df = _prepare(df, region_col)
    S.require(df, "region_id", "total_population", what="census")
    return _typed(
        df,
        {
            "region_id": F.col("region_id").cast("string"),
            "total_population": C.whole_number(df, "total_population"),
            **_optional_number(df, "median_income"),
            **_optional_number(df, "poverty_rate"),
        },
        {
            "region_id missing": F.col("region_id").isNotNull(),
            "total_population not a count": F.col("total_population") >= 0,
            "median_income not a number": _is_number_or_missing("median_income"),
            "poverty_rate not a number": _is_number_or_missing("poverty_rate"),
        },
    )


def clean_facilities(df: DataFrame, region_col: str | None = None) -> Validated:
    """facility_id and facility_type; region_id and capacity optional.

    A table without facility ids gets content hashes, one without types gets ``unknown``. Other columns,
    the geometry among them, are kept.
    """
    df = _prepare(df, region_col)
    if "facility_id" not in df.columns:
        df = df.withColumn("facility_id", content_id(df))
    if "facility_type" not in df.columns:
        df = df.withColumn("facility_type", F.lit("unknown"))
    contract = {
        "facility_id": F.col("facility_id").cast("string"),
        "region_id": _optional_text(df, "region_id"),
        "facility_type": F.col("facility_type").cast("string"),
        **_optional_number(df, "capacity"),
    }
    extra = [c for c in df.columns if c not in contract]
    return _typed(
        df,
        contract,
        {
            "facility_id missing": F.col("facility_id").isNotNull(),
            "facility_type missing": F.col("facility_type").isNotNull(),
            "capacity not a number": _is_number_or_missing("capacity"),
        },
        extra,
    )


def content_id(df: DataFrame, prefix: str = "fac_") -> Column:
    """Identifier from the row's content: it does not depend on row order or on which task reads the row."""
    return F.concat(F.lit(prefix), F.xxhash64(*[N.quoted(c) for c in df.columns]).cast("string"))


def clean_boundaries(df: DataFrame, region_col: str = "region_id") -> Validated:
    """region_id; name optional. Other columns, the geometry among them, are kept."""
    df = _prepare(df, region_col)
    S.require(df, "region_id", what="boundaries")
    contract = {"region_id": F.col("region_id").cast("string"), "name": _optional_text(df, "name")}
    extra = [c for c in df.columns if c not in contract]
    return _typed(df, contract, {"region_id missing": F.col("region_id").isNotNull()}, extra)


def clean_demand_long(df: DataFrame) -> Validated:
    """Non-empty region_id and activity, demand >= 0; a demand that is not a number counts as zero."""
    df = N.standardize_columns(df)
    S.require(df, "region_id", "activity", "demand", what="long demand")
    return _typed(
        df,
        {
            "region_id": C.upper_id(F.col("region_id")),
            "activity": C.strip(F.col("activity").cast("string")),
            "demand": C.filled(C.number(df, "demand").cast("double")),
        },
        {
            "region_id empty": F.col("region_id") != "",
            "activity empty": F.col("activity") != "",
            "demand negative": F.col("demand") >= 0,
        },
    )
