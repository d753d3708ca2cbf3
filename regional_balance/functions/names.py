"""Column-name work. It runs on ``df.columns`` while the plan is built and never starts a job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TO_UNDERSCORE = str.maketrans({" ": "_", "-": "_"})
_NOISE = str.maketrans("", "", " \t/_\\-")


def standard_name(name: str) -> str:
    return name.strip().lower().translate(_TO_UNDERSCORE)


def name_key(name: str) -> str:
    """Same key for a column name as ``columns.label_key`` gives for a label in the data."""
    return name.strip().translate(_NOISE).lower()


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])


def strip_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def find_by_name(columns: Sequence[str], candidates: Iterable[str]) -> str | None:
    """First candidate present, ignoring case and outer blanks; of equal names the last column wins."""
    by_lower = {c.strip().lower(): c for c in columns}
    return next((by_lower[k] for k in candidates if k in by_lower), None)


def find_label_column(columns: Sequence[str], label: str) -> str | None:
    """First column that spells ``label``, ignoring case, blanks and punctuation."""
    want = name_key(label)
    return next((c for c in columns if name_key(c) == want), None)


def find_region_column(columns: Sequence[str], candidates: Iterable[str], activities: Iterable[str]) -> str | None:
    """A named region column, else the first column that is neither an activity nor unnamed."""
    named = find_by_name(columns, candidates)
    if named is not None:
        return named
    taken = {name_key(a) for a in activities}
    rest = (c for c in columns if name_key(c) not in taken and not c.strip().lower().startswith("unnamed"))
    return next(rest, None)


def first_numeric_column(df: DataFrame, exclude: Iterable[str] = ()) -> str | None:
    skip = set(exclude)
    fields = (f for f in df.schema.fields if f.name not in skip)
    return next((f.name for f in fields if isinstance(f.dataType, T.NumericType)), None)


def activity_columns(df: DataFrame, activities: Iterable[str]) -> dict[str, str]:
    """Canonical activity label -> column of ``df`` that carries it; absent activities are left out."""
    found = {a: find_label_column([c for c in df.columns if c.lower() != "region_id"], a) for a in activities}
    return {a: c for a, c in found.items() if c is not None}


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop superseded columns; names that are absent are ignored."""
    return df.drop(*names)


def quoted(name: str):
    return F.col(f"`{name}`")
