"""Quality rules: fixed limits, then robust multivariate outliers among the documents of a language and source.

Each document gives a vector of transformed statistics. For every (language, source), every language and the whole
table a minimum-covariance-determinant estimate is fitted: from medians and quartile ranges on, concentration steps
take the share ``support`` of rows with the smallest Mahalanobis distances and estimate anew. A step is one
aggregation over all rows: partial sums per group and distance class, then a few numbers per group. A document is
judged by the estimate of its source if that has ``least_rows`` rows, else of its language, else of the table; it is rejected if its
squared distance exceeds the cutoff.

Null text counts as no words and fails the base rule; null languages and sources are groups of their own. Repeated rows
are judged alike. Where fewer than ``least_rows`` rows pass the base rule in all, the base rule alone decides.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from regional_balance.llm.common import free_name, same, slices, store, texts

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shout"]
DIMS = ["x_length", "x_symbols", "x_lines", "x_repeats", "x_upper", "x_shout"]

#: Smallest standard deviation taken for each of DIMS: what varies less is not evidence of an outlier by itself.
FLOORS = [0.05, 0.05, 0.15, 0.15, 0.05, 0.05]

BLANK, SYMBOLS = b" \t\n\r\v\f", b"#*$%&|<>"
CAPITALS, SHOUTS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!?~^_=+"

#: Squared distances are counted in classes, so many to a doubling of 1 + distance; the support share ends with a class.
CLASSES = 16


def count_of(raw: bytes, kinds: bytes) -> int:
    return len(raw) - len(raw.translate(None, kinds))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = reach = 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(reach, i)
            reach = i + 3
    return covered


def statistics(text: str) -> tuple[int, ...]:
    """STATS of a text. Words are runs without ASCII white space."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - count_of(raw, BLANK),
        count_of(raw, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        count_of(raw, CAPITALS),
        count_of(raw, SHOUTS),
    )


def with_statistics(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with STATS of its text under the given names."""
    schema = docs.schema
    for name in names:
        schema = StructType([*schema.fields, StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([statistics(t) for t in texts(batch)], np.int64)
            columns = [pa.array(found[:, i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def vector(stat: dict[str, Column]) -> list[Column]:
    """DIMS: log of the mean word length and square roots of shares, which evens out their spread."""
    words, chars = F.greatest(stat["n_words"], F.lit(1)), F.greatest(stat["word_chars"], F.lit(1))
    return [
        F.log(chars / words),
        F.sqrt(stat["n_symbols"] / words),
        F.sqrt(stat["n_dup_lines"] / F.greatest(stat["n_lines"], F.lit(1))),
        F.sqrt(stat["n_repeat_words"] / words),
        F.sqrt(stat["n_upper"] / chars),
        F.sqrt(stat["n_shout"] / words),
    ]


def squared_distance(x: list[Column], centre: Column, precision: Column) -> Column:
    off = [v - centre[i] for i, v in enumerate(x)]
    d = len(x)
    terms = [precision[i * d + j] * off[i] * off[j] * (1 if i == j else 2) for i in range(d) for j in range(i, d)]
    return sum(terms[1:], terms[0])


def concentrated(groups: pd.DataFrame, support: float) -> tuple[list[float], list[float]]:
    """Centre and precision from the sums per distance class of one group, nearest classes first."""
    groups = groups.sort_values("class")
    n = groups["n"].to_numpy()
    near = np.cumsum(n) - n < support * n.sum()
    d = len(DIMS)
    total = n[near].sum()
    sums = groups.loc[near, [f"s{i}" for i in range(d)]].sum().to_numpy()
    centre = sums / total
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = groups.loc[near, f"p{i}_{j}"].sum() / total - centre[i] * centre[j]
    cov += np.diag(np.maximum(0, np.square(FLOORS) - np.diag(cov)))
    values, vectors = np.linalg.eigh(cov)
    values = np.maximum(values, np.square(FLOORS).min() / 4)
    return centre.tolist(), ((vectors / values) @ vectors.T).ravel().tolist()


KEY = ["level", "g_lang", "g_source"]


def levels(lang: Column, source: Column) -> Column:
    """The groups a row counts in: its source in its language, its language, the table."""
    none = F.lit(None).cast("string")
    pairs = [(0, lang, source), (1, lang, none), (2, none, none)]
    return F.explode(F.array(*(F.struct(F.lit(i).alias(KEY[0]), a.alias(KEY[1]), b.alias(KEY[2])) for i, a, b in pairs)))


def on_key(rows: DataFrame, estimates: DataFrame, names: list[str]) -> DataFrame:
    """Join estimates to rows. They are broadcast while there are at most 50,000 groups (under 30 MB)."""
    side = estimates.select(*(F.col(n).alias(f"e_{n}") for n in names), *(c for c in estimates.columns if c not in names))
    side = F.broadcast(side) if estimates.count() <= 50_000 else side
    condition = [same(F.col(n), F.col(f"e_{n}")) for n in names]
    return rows.join(side, condition).drop(*(f"e_{n}" for n in names))


def fit(stats: DataFrame, support: float = 0.75, steps: int = 5, least_rows: int = 50) -> DataFrame:
    """(lang, source, centre, precision): the estimate by which documents of each language and source are judged.

    ``stats``: a stored table of (lang, source, STATS); rows that fail the base rule take no part.
    """
    rows = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    x = vector({s: F.col(s) for s in STATS})
    rows = rows.select(levels(F.col("lang"), F.col("source")).alias("key"), *(v.alias(n) for v, n in zip(x, DIMS)))
    rows = rows.select("key.*", *DIMS)
    dims = [F.col(n) for n in DIMS]

    quartiles = [F.percentile_approx(v, [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i, v in enumerate(dims)]
    start = rows.groupBy(*KEY).agg(F.count("*").alias("n"), *quartiles)
    spread = [F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(f)) for i, f in enumerate(FLOORS)]
    diagonal = [1 / spread[i] ** 2 if i == j else F.lit(0.0) for i in range(len(dims)) for j in range(len(dims))]
    centre = F.array(*(F.col(f"q{i}")[1] for i in range(len(dims))))
    estimates = store(start.select(*KEY, "n", centre.alias("centre"), F.array(*diagonal).alias("precision")), "mcd")

    def step(key: tuple, groups: pd.DataFrame) -> pd.DataFrame:
        found = concentrated(groups, support)
        return pd.DataFrame([[*key, int(groups["n"].sum()), *found]], columns=[*KEY, "n", "centre", "precision"])

    moments = [F.sum(v).alias(f"s{i}") for i, v in enumerate(dims)]
    moments += [F.sum(dims[i] * dims[j]).alias(f"p{i}_{j}") for i in range(len(dims)) for j in range(i, len(dims))]
    for _ in range(steps):
        near = on_key(rows, estimates.drop("n"), KEY)
        classed = near.withColumn(
            "class", F.floor(F.log2(1 + F.greatest(squared_distance(dims, F.col("centre"), F.col("precision")), F.lit(0))) * CLASSES)
        )
        sums = classed.groupBy(*KEY, "class").agg(F.count("*").alias("n"), *moments)
        estimates = store(sums.groupBy(*KEY).applyInPandas(step, estimates.schema), "mcd")

    wanted = stats.select("lang", "source").distinct()
    candidates = wanted.select("lang", "source", levels(F.col("lang"), F.col("source")).alias("key")).select("lang", "source", "key.*")
    usable = estimates.where(F.col("n") >= least_rows)
    chosen = on_key(candidates, usable, KEY).groupBy("lang", "source")
    return chosen.agg(F.min_by(F.struct("centre", "precision"), "level").alias("e")).select("lang", "source", "e.*")


def judged(stats: DataFrame, estimates: DataFrame, names: dict[str, str], cutoff: float) -> DataFrame:
    """``stats`` with _base, _distance and _kept; ``names`` maps STATS to their columns there."""
    stat = {s: F.col(n) for s, n in names.items()}
    side = estimates.select(*(F.col(c).alias(f"_{c}") for c in estimates.columns))
    side = F.broadcast(side) if estimates.count() <= 50_000 else side
    rows = stats.join(side, same(F.col("lang"), F.col("_lang")) & same(F.col("source"), F.col("_source")), "left")
    distance = squared_distance(vector(stat), F.col("_centre"), F.col("_precision"))
    rows = rows.withColumn("_base", base_failed(stat["n_words"], stat["n_repeat_words"])).withColumn("_distance", distance)
    return rows.withColumn("_kept", ~F.col("_base") & (F.coalesce("_distance", F.lit(0.0)) <= cutoff))


def table_of_statistics(docs: DataFrame) -> DataFrame:
    kinds = [F.col(c).cast("string").alias(c) for c in ("lang", "source")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kinds, "text")
    return store(with_statistics(rows, STATS).drop("text"), "statistics")


def quality_verdicts(docs: DataFrame, cutoff: float = 80.0, support: float = 0.75) -> DataFrame:
    """(doc_id, STATS, base_failed, distance, kept) for every row; distance is null where there is no estimate."""
    stats = table_of_statistics(docs)
    estimates = store(fit(stats, support), "mcd")
    rows = judged(stats, estimates, {s: s for s in STATS}, cutoff)
    return rows.select(
        "doc_id", *STATS, F.col("_base").alias("base_failed"), F.col("_distance").alias("distance"), F.col("_kept").alias("kept")
    )


def keep_good(docs: DataFrame, cutoff: float = 80.0, support: float = 0.75) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged. The statistics are worked out again beside the texts: no text is shuffled."""
    estimates = store(fit(table_of_statistics(docs), support), "mcd")
    names = {s: free_name(docs, f"_{s}") for s in STATS}
    return judged(with_statistics(docs, list(names.values())), estimates, names, cutoff).where("_kept").select(*docs.columns)
