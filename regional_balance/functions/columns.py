"""Scalar rules as Column -> Column functions. All stay in the JVM; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regional_balance import schema as S

# Every character Python's str.strip() removes, from the rule rather than a list.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)$"
_LABEL_NOISE = " \t/_\\-"
_INF = float("inf")


def strip(c: Column) -> Column:
    """Trim all white space at both ends (Spark's ``trim`` only takes blanks)."""
    return F.btrim(c, F.lit(WHITESPACE))


def label_key(c: Column) -> Column:
    """Spelling-insensitive key of a label: ``Walking / Jogging`` -> ``walkingjogging``."""
    return F.lower(F.translate(strip(c), _LABEL_NOISE, ""))


def upper_id(c: Column) -> Column:
    """Identifier as trimmed upper-case text; missing stays missing."""
    return F.upper(strip(c.cast("string")))


def text_merge_key(c: Column) -> Column:
    """Region key of a text column: blank and ``nan`` become ``''``, ``36001.0`` becomes ``36001``."""
    s = strip(c)
    whole = F.regexp_replace(s, r"^(\d+)\.0$", "$1")
    key = F.upper(F.regexp_replace(whole, _SPACE_RUN, " "))
    return F.when(s.isNull() | (s == "") | (F.lower(s) == "nan"), F.lit("")).otherwise(key)


def whole_digits(c: Column) -> Column:
    """Digits of a whole double of any size: the fewest that tell it from its neighbours, then zeros."""
    return F.format_string("%.0f", c + F.lit(0.0))


def float_merge_key(c: Column) -> Column:
    """Region key of a floating column: whole numbers are written without exponent or ``.0``."""
    whole = (c == F.rint(c)) & (F.abs(c) < F.lit(_INF))
    text = F.when(whole, whole_digits(c)).otherwise(F.upper(c.cast("string")))
    return F.when(c.isNull() | F.isnan(c), F.lit("")).otherwise(text)


def merge_key(df: DataFrame, name: str) -> Column:
    """Region merge key of a column, by its type: numbers must be formatted before they become text."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float_merge_key(c.cast("double"))
    if isinstance(kind, T.DecimalType):
        return float_merge_key(c.cast("double"))
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.coalesce(F.upper(c.cast("string")), F.lit(""))
    return text_merge_key(c.cast("string"))


def boundary_region_id(c: Column, aliases: Mapping[str, str] = S.BOUNDARY_ALIASES) -> Column:
    """Region id of a boundary name, with renamed regions mapped to the name used elsewhere."""
    name = upper_id(c)
    if not aliases:
        return name
    pairs = [F.lit(v) for kv in aliases.items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """Null for infinities and NaN (Spark orders NaN above infinity, so one upper bound is enough)."""
    return F.when((c < F.lit(_INF)) & (c > F.lit(-_INF)), c)


def text_number(c: Column) -> Column:
    """Number in a text column, or null. ``cast`` alone would raise, and takes ``1d`` as a number."""
    s = strip(c)
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def number(df: DataFrame, name: str) -> Column:
    """Numeric view of a column by its type; decimals stay exact so that sums do not depend on order."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.DecimalType):
        return c
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(c.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return text_number(c.cast("string"))


def whole_number(df: DataFrame, name: str) -> Column:
    """Integer view of a column: null unless the value is integral and fits a long."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    n = number(df, name)
    return F.when(n == F.rint(n.cast("double")), n.try_cast("long"))


def filled(c: Column) -> Column:
    """Missing demand counts as zero."""
    return F.coalesce(c, F.lit(0.0))


def clipped(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Clip into a range; missing stays missing (``greatest``/``least`` would skip nulls)."""
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(c.isNotNull(), out)


def is_summary_row(c: Column, markers: Iterable[str] = S.SUMMARY_ROW_MARKERS) -> Column:
    """True for footer rows such as ``GRAND TOTAL``; a missing label is not a footer."""
    text = F.lower(c.cast("string"))
    hit = F.lit(False)
    for marker in markers:
        hit = hit | text.contains(marker)
    return F.coalesce(hit, F.lit(False))


def participation_rate(participants: Column, population: Column) -> Column:
    return filled(finite(F.try_divide(participants.cast("double"), population.cast("double"))))


def need_score(demand: Column, supply: Column, scale: float = S.ScoreParams.scale) -> Column:
    """demand / supply x scale, null where supply is zero or missing."""
    return finite(F.try_divide(demand, supply) * F.lit(float(scale)))


def supply_demand_ratio(demand: Column, supply: Column) -> Column:
    return F.when(demand > 0, finite(F.try_divide(supply, demand)))


def need_class(score: Column, supply: Column, params: S.ScoreParams = S.ScoreParams()) -> Column:
    """Band of a score. A missing score with supply present (supply zero) has no class."""
    return (
        F.when(supply.isNull(), F.lit(S.CLASS_NO_SUPPLY))
        .when(score < params.low, F.lit(S.CLASS_SUFFICIENT))
        .when(score <= params.high, F.lit(S.CLASS_BALANCED))
        .when(score > params.high, F.lit(S.CLASS_NEEDS))
    )


def needs_improvement(score: Column, klass: Column, threshold: float = S.IMPROVEMENT_THRESHOLD) -> Column:
    no = F.lit(False)
    return F.coalesce(score > threshold, no) | F.coalesce(klass.contains(S.CLASS_NEEDS), no)


def share_of_total(value: Column, total: Column) -> Column:
    return F.when(total > 0, F.try_divide(value, total)).otherwise(value)


def score_text(score: Column, decimals: int = 3, missing: str = "-") -> Column:
    """Fixed-point text, rounded from the exact binary value (``format_string`` rounds the shortest digits).

    Whole and fractional part are both exact as doubles, and the fraction alone has digits to spare. From 2 ** 53 on there is
    no fraction.
    """
    size = F.abs(score)
    small = size < F.lit(2.0**53)
    whole = F.when(small, F.floor(size)).cast("double")
    exact = whole.cast("decimal(38,18)") + (size - whole).cast("decimal(38,18)")
    digits = F.bround(exact, decimals).cast(T.DecimalType(38, decimals)).cast("string")
    zeros = "." + "0" * decimals if decimals else ""
    plain = F.when(small, digits).otherwise(F.concat(whole_digits(size), F.lit(zeros)))
    text = F.when(score < 0, F.concat(F.lit("-"), plain)).otherwise(plain)
    return F.coalesce(F.when(score.isNotNull(), text), F.lit(missing))


def region_text(region: Column, width: int = 20) -> Column:
    return F.substring(region, 1, width)


def score_or_sentinel(score: Column, sentinel: float = S.NO_SCORE_SENTINEL) -> Column:
    return F.coalesce(score, F.lit(float(sentinel)))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"[^.](\.[^.]+)$", 1))


def input_role(path: Column) -> Column:
    """``demand`` or ``supply`` by markers in the file name; null for none, both, or a lock file."""
    name = F.lower(file_name(path))

    def any_of(tests):
        hit = F.lit(False)
        for t in tests:
            hit = hit | t
        return hit

    demand = any_of([name.contains(m) for m in S.DEMAND_MARKERS] + [name.startswith(p) for p in S.DEMAND_PREFIXES])
    supply = any_of([name.contains(m) for m in S.SUPPLY_MARKERS])
    locked = strip(name).startswith(S.LOCK_PREFIX)
    return F.when(demand & ~supply & ~locked, F.lit("demand")).when(supply & ~demand & ~locked, F.lit("supply"))
