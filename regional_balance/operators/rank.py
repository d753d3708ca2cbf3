"""Competition rank that no single task has to hold, however large the table or its largest group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


WAYS = 16  # branches of one search step


def search_steps(df: DataFrame) -> int:
    """Search steps, each cutting sixteen-fold, for at least four ranges per shuffle partition: 256 or 4,096 ranges."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 2 if 4 * partitions <= WAYS**2 else 3


def _add_range(counts: DataFrame, splits: Column, score: str, steps: int) -> DataFrame:
    """Add ``_range``, the number of split points below the score, by a search in the sorted array.

    One projection per step; plain projections stay inside generated code, which a lambda over the array would not.
    """
    ranged = counts.withColumns({"_splits": splits, "_range": F.lit(0)})
    for step in (WAYS**i for i in reversed(range(steps))):
        tests = " ".join(
            f"WHEN get(_splits, _range + {k * step - 1}) < `{score}` THEN {k * step}" for k in reversed(range(1, WAYS))
        )
        ranged = ranged.withColumn("_range", F.expr(f"_range + CASE {tests} ELSE 0 END"))
    return ranged.drop("_splits")


def rank_values(
    df: DataFrame,
    score: str,
    by: Sequence[str] = (),
    rank: str = "priority_rank",
    steps: int | None = None,
) -> DataFrame:
    """(by..., score, rank) for each distinct non-missing score, highest first.

    1. Equal scores are counted first (map-side too), so a score shared by a third of the rows is one row.
    2. The distinct scores are cut into ranges at split points. The points are the distinct scores with the
       smallest hashes: an even sample that depends on the data only, so a recomputed task, or a branch of the
       plan that Spark does not reuse, gets the same ranges.
    3. Within a range a window counts the rows above. Range totals, at most 4,096 per group, give what lies
       in the ranges above.
    """
    by = list(by)
    steps = steps or search_steps(df)
    counts = df.filter(F.col(score).isNotNull()).groupBy(*by, score).agg(F.count(F.lit(1)).alias("_n"))
    # Ordering by the count too keeps it in the sample's aggregate, which then is the same exchange as `counts`.
    hashed = counts.withColumn("_h", F.xxhash64(*by, score)).orderBy("_h", score, *by, "_n")
    splits = hashed.limit(WAYS**steps - 1).agg(F.sort_array(F.collect_set(score)).alias("splits"))
    ranged = _add_range(counts, splits.scalar(), score, steps)

    # At most WAYS**steps rows per group, whatever the table holds: one task can add these up, also without groups.
    totals = ranged.groupBy(*by, "_range").agg(F.sum("_n").alias("_n"))
    ranges_above = Window.partitionBy(*by).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_range").alias("_offset_range"),
        F.coalesce(F.sum("_n").over(ranges_above), F.lit(0)).alias("_above"),
    )

    higher = Window.partitionBy(*by, "_range").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("_within", F.coalesce(F.sum("_n").over(higher), F.lit(0)))
    same = F.col("_range") == F.col("_offset_range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    position = (F.col("_within") + F.col("_above") + 1).alias(rank)
    # Every range has an offset. A left join says so without an inferred filter, which would evaluate the
    # range of every input row at the scan.
    return within.join(offsets, same, "left").select(*by, score, position)


def add_rank(
    df: DataFrame,
    score: str = "need_score",
    by: Sequence[str] = (),
    rank: str = "priority_rank",
    steps: int | None = None,
) -> DataFrame:
    """Add the rank of ``score`` (descending, ties share the smallest rank, missing scores unranked)."""
    by = list(by)
    ranks = rank_values(df, score, by, rank, steps)
    ranks = ranks.select(F.col(score).alias("_ranked_score"), F.col(rank), *[F.col(c).alias(f"_by_{c}") for c in by])
    same = F.col(score) == F.col("_ranked_score")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    found = df.drop(rank).join(ranks, same, "left")
    # A score that changes when it is computed again would find no rank: an error, not a missing rank.
    lost = F.raise_error(F.lit(f"{score} has no rank: it is not the same each time it is computed; settle it first"))
    position = F.when(F.col(rank).isNull() & F.col(score).isNotNull(), lost.cast("long")).otherwise(F.col(rank))
    return found.select(*[F.col(c) for c in df.columns if c != rank], position.alias(rank))
