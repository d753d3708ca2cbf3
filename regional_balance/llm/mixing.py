"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree, in built-in functions.

Sizes are words. Every source has a target; what it offers is its documents in a permuted order, read round after round
until the target is reached: whole passes, then part of one. That stream is cut into blocks of equally many words, as
many as the source's quota. Quotas add up to shards x blocks per shard, and a tree splits them: each node halves its
shards and draws, source after source, how many of its blocks go left - a hypergeometric draw that leaves exact totals
on both sides. At the leaves every shard holds its number of blocks, in a mix drawn at random without replacement. A
source's blocks are permuted and dealt to shards in disjoint runs of these counts; rows are shuffled within a shard.

All draws are functions of the seed and of ids, so reruns agree. A source's order is cut into buckets by hash, so that
running sums need no window over a whole source.

Null text has size 0 and null sources are one source, the last. Repeated rows (same doc_id, source and text) are one
unit with a multiplicity, drawn alike. Documents of size 0 take no words and are drawn in whole passes only.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regional_balance.llm.common import WORD, free_name, partitions, same, store, text_column

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
#: Documents of one bucket of a source's order, about; a window sorts a bucket.
BUCKET_ROWS = 5_000
#: Orders tried in the bucket in which a source's last pass ends.
ORDERS = 8


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on its arguments alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def units(docs: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, text_hash, size, copies, key): a row for each distinct document, key being its place in the order."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(text_column()).alias("text_hash"),
        F.regexp_count(text_column(), F.lit(WORD)).cast("long").alias("size"),
    )
    rows = rows.groupBy("doc_id", "source", "text_hash", "size").agg(F.count("*").alias("copies"))
    return rows.withColumn("key", uniform(F.lit(seed), "doc_id", "text_hash"))


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_times: float = MOST_TIMES) -> DataFrame:
    """(source, source_size, n_docs, target): sources by code point, null last, take the weights in turn.

    Targets are shares of all words, at most ``most_times`` the source's size. Sources reach that bound in the order of
    size per weight; the rest share what is left by weight, which is where repeated resharing ends.
    """
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_docs"))
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ranked = ranked.withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int")))
    ranked = ranked.withColumn("bound", F.col("source_size") * F.lit(float(most_times)))
    order = Window.orderBy(F.col("bound") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole)
    level = (total - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    ranked = ranked.withColumn("level", level).withColumn("full", F.col("bound") < F.col("weight") * F.col("level"))
    shared = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)
    target = F.when(F.col("full") | shared.isNull(), F.col("bound")).otherwise(F.least("bound", F.col("weight") * shared))
    return ranked.select("source", "rank", "source_size", "n_docs", target.alias("target"))


def ordered(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's columns and ``start``: words of the source before them in the permuted order.

    Buckets are ranges of the uniform key: sums per bucket, running sums over a source's buckets, windows in buckets.
    """
    buckets = F.greatest(F.lit(1), F.floor(F.col("n_docs") / BUCKET_ROWS))
    side = sources.withColumnRenamed("source", "s_source")
    joined = rows.join(F.broadcast(side), same(F.col("source"), F.col("s_source"))).drop("s_source")
    joined = joined.withColumn("bucket", F.floor(F.col("key") * buckets)).withColumn("words", F.col("size") * F.col("copies"))
    sums = joined.groupBy("rank", "bucket").agg(F.sum("words").alias("bucket_words"))
    running = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("bucket_words").over(running), F.lit(0)).alias("bucket_start"))
    inner = Window.partitionBy("rank", "bucket").orderBy("key", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    joined = joined.join(sums, ["rank", "bucket"])
    return joined.withColumn("start", F.col("bucket_start") + F.coalesce(F.sum("words").over(inner), F.lit(0)))


def drawn(rows: DataFrame) -> DataFrame:
    """Rows with ``times``: how often the mix takes each document.

    Whole passes come first. The last, partial one takes whole buckets while they fit in the rest. In the bucket in which
    it ends, several orders are tried: documents are taken in order while they fit, then, three rounds more, those of the
    others that still fit, and one beyond if that comes nearer. The order that ends nearest to the rest counts.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = rows.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    last = rows.where(F.col("bucket_start") <= F.col("rest")).groupBy("rank").agg(F.max("bucket").alias("last_bucket"))
    rows = rows.join(F.broadcast(last), "rank")
    plain = rows.where("bucket <> last_bucket").withColumn("taken", (F.col("words") > 0) & (F.col("bucket") < F.col("last_bucket")))

    tries = F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1)))
    final = rows.where("bucket = last_bucket").withColumn("order", tries).withColumn("taken", F.lit(False))
    final = final.withColumn("turn", uniform("order", "doc_id", "text_hash"))
    group = Window.partitionBy("rank", "order")
    order = group.orderBy("turn", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def with_room(df: DataFrame) -> DataFrame:
        used = F.coalesce(F.sum(F.when(F.col("taken"), F.col("words"))).over(group), F.lit(0))
        return df.withColumn("room", F.col("rest") - F.col("bucket_start") - used)

    for _ in range(4):
        final = with_room(final)
        fits = ~F.col("taken") & (F.col("words") > 0) & (F.col("words") <= F.col("room"))
        final = final.withColumn("sum", F.sum(F.when(fits, F.col("words")).otherwise(0)).over(order))
        final = final.withColumn("taken", F.col("taken") | (fits & (F.col("sum") <= F.col("room"))))
    final = with_room(final).withColumn("off", F.abs(F.col("words") - F.col("room")))
    nearest = F.row_number().over(group.orderBy("taken", "off", "turn", "doc_id", "text_hash")) == 1
    final = final.withColumn("more", ~F.col("taken") & nearest & (F.col("off") < F.col("room")))
    miss = F.min(F.when(F.col("more"), F.col("off")).otherwise(F.col("room"))).over(group)
    final = final.withColumn("taken", F.col("taken") | F.col("more")).withColumn("miss", miss)
    final = final.withColumn("best", F.min(F.struct("miss", "order")).over(Window.partitionBy("rank"))["order"]).where("order = best")
    rows = plain.unionByName(final.select(*plain.columns))
    times = F.col("passes") + F.col("taken").cast("int")
    return rows.withColumn("times", times.cast("long")).drop("passes", "rest", "taken", "last_bucket")


def log_factorial(n: Column) -> Column:
    """ln n!, from the table up to 20 and from Stirling's series beyond (exact to 12 digits)."""
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of good ones among ``draws`` of ``total`` without replacement: where the distribution function passes u.

    The probability of the least number comes from logarithms of factorials, the others from the ratio of neighbours.
    """
    bad = total - good
    low = F.greatest(F.lit(0).cast("long"), draws - bad)
    high = F.least(good, draws)
    first = log_choose(good, low) + log_choose(bad, draws - low) - log_choose(total, draws)
    state = F.struct(first.alias("log"), F.exp(first).alias("sum"), low.alias("at"))

    def step(acc: Column, x: Column) -> Column:
        up = acc["log"] + F.log(((good - x + 1) * (draws - x + 1)).cast("double") / (x * (bad - draws + x)))
        at = F.when(acc["sum"] <= u, x).otherwise(acc["at"])
        return F.struct(up.alias("log"), (acc["sum"] + F.exp(up)).alias("sum"), at.alias("at"))

    walk = F.aggregate(F.sequence(low + 1, F.greatest(high, low + 1)), state, step, lambda acc: acc["at"])
    return F.when(high > low, walk).otherwise(low)


def quotas(sources: DataFrame, blocks: int) -> DataFrame:
    """(rank, target, quota): one block for each source with a target, the others by largest remainder."""
    live = sources.where("target > 0")
    whole = Window.partitionBy()
    spare = F.lit(blocks) - F.count("*").over(whole)
    share = F.col("target") / F.sum("target").over(whole) * spare
    live = live.withColumn("share", share).withColumn("floor", F.floor("share"))
    left = spare - F.sum("floor").over(whole)
    order = Window.orderBy((F.col("share") - F.col("floor")).desc(), "rank")
    live = live.withColumn("left", left).withColumn("place", F.row_number().over(order))
    quota = 1 + F.col("floor") + (F.col("place") <= F.col("left")).cast("long")
    return live.select("rank", "target", quota.cast("long").alias("quota"))


def draw_left(seed: int, depth: int):
    """One source's step in splitting a node: its blocks that go left, out of what the sources before it left over."""

    def step(acc: Column, x: Column) -> Column:
        u = uniform(F.lit(seed), F.lit(depth), F.col("first"), x["rank"])
        drawn_once = F.array(hypergeometric(acc["total"], x["n"], acc["draws"], u))

        def out(n: Column) -> Column:
            return F.struct(
                (acc["total"] - x["n"]).alias("total"),
                (acc["draws"] - n).alias("draws"),
                F.array_append(acc["left"], F.struct(x["rank"].alias("rank"), n.alias("n"))).alias("left"),
            )

        return F.transform(drawn_once, out)[0]

    return step


def splitting_tree(quota: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, rank, blocks): exact block counts of every shard, from a table (rank, quota) whose sum is a multiple of shards.

    A row is a node: its shards and the quotas of all sources. One level of the tree after the other is split.
    """
    listed = F.sort_array(F.collect_list(F.struct("rank", F.col("quota").cast("long").alias("n"))))
    nodes = quota.agg(listed.alias("mix")).select(F.lit(0).alias("first"), F.lit(shards).alias("width"), "mix")
    width = shards
    depth = 0
    while width > 1:
        left_width = F.floor(F.col("width") / 2)
        total = F.aggregate("mix", F.lit(0).cast("long"), lambda a, x: a + x["n"])
        part = (total * left_width / F.col("width")).cast("long")
        state = F.struct(total.alias("total"), part.alias("draws"), F.array().cast("array<struct<rank:int,n:bigint>>").alias("left"))
        drawn_left = F.aggregate("mix", state, draw_left(seed, depth), lambda acc: acc["left"])
        split = nodes.withColumn("left", F.when(F.col("width") > 1, drawn_left))
        rest = F.zip_with("mix", "left", lambda a, b: F.struct(a["rank"].alias("rank"), (a["n"] - b["n"]).alias("n")))
        halves = F.array(
            F.struct(F.col("first").alias("first"), left_width.cast("int").alias("width"), F.col("left").alias("mix")),
            F.struct(
                (F.col("first") + left_width).cast("int").alias("first"), (F.col("width") - left_width).cast("int").alias("width"), rest.alias("mix")
            ),
        )
        whole = F.array(F.struct("first", F.col("width").cast("int").alias("width"), "mix"))
        nodes = split.select(F.explode(F.when(F.col("width") > 1, halves).otherwise(whole)).alias("node")).select("node.*")
        nodes = store(nodes, "tree")
        width = -(-width // 2)
        depth += 1
    leaves = nodes.select(F.col("first").alias("shard"), F.explode("mix").alias("m"))
    return leaves.select("shard", F.col("m.rank").alias("rank"), F.col("m.n").alias("blocks"))


def dealt_blocks(quota: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """(rank, block, shard): each source's blocks in a permuted order, cut into the shards' disjoint runs."""
    blocks = quota.select("rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("block"))
    order = Window.partitionBy("rank").orderBy(uniform(F.lit(seed), F.lit("deal"), "rank", "block"), "block")
    blocks = blocks.withColumn("place", F.row_number().over(order))
    ends = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = leaves.where("blocks > 0").withColumn("end", F.sum("blocks").over(ends))
    runs = runs.select("rank", "shard", F.explode(F.sequence(F.col("end") - F.col("blocks") + 1, F.col("end"))).alias("place"))
    return blocks.join(runs, ["rank", "place"]).select("rank", "block", "shard")


def mix(docs: DataFrame, seed: int = 7, shards: int = 64, blocks_per_shard: int = 64) -> DataFrame:
    """(doc_id, source, text_hash, copies, size, source_size, target, times, draws): a row for each distinct document.

    ``draws`` lists (shard, place) of each time it is taken, place being a uniform number to shuffle the shard by.
    ``shards * blocks_per_shard`` bounds the tables of the tree and all that is broadcast; more sources are an error.
    """
    rows = store(units(docs, seed), "units")
    sources = store(targets(rows), "sources")
    n_sources = sources.count()
    if n_sources > shards * blocks_per_shard:
        raise ValueError(f"{n_sources} sources need more than {shards} x {blocks_per_shard} blocks; raise either parameter")
    quota = store(quotas(sources, shards * blocks_per_shard), "quotas")
    blocks = dealt_blocks(quota, splitting_tree(quota.select("rank", "quota"), shards, seed), seed)
    taken = store(drawn(ordered(rows, sources)), "drawn")

    draws = taken.where("times > 0").join(F.broadcast(quota.select("rank", "quota")), "rank")
    draws = draws.select(
        "rank", "doc_id", "text_hash", "quota", "target", "source_size", "start", F.explode(F.sequence(F.lit(1), "times")).alias("turn")
    )
    at = (F.col("turn") - 1) * F.col("source_size") + F.col("start")
    block = F.least(F.col("quota") - 1, F.floor(at / F.col("target") * F.col("quota")))
    draws = draws.withColumn("block", block)
    draws = draws.join(F.broadcast(store(blocks, "blocks")), ["rank", "block"])
    place = uniform(F.lit(seed), F.lit("place"), "doc_id", "text_hash", "turn")
    listed = draws.groupBy("rank", "doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("shard", place.alias("place"), "turn"))).alias("draws")
    )
    ids = ["rank", "doc_id", "text_hash"]
    listed = listed.select(*(F.col(c).alias(f"l_{c}") for c in ids), "draws")
    out = taken.join(listed, [same(F.col(c), F.col(f"l_{c}")) for c in ids], "left")
    return out.select("doc_id", "source", "text_hash", "copies", "size", "source_size", "target", "times", "draws")


def mixed_sizes(docs: DataFrame, seed: int = 7, shards: int = 64, blocks_per_shard: int = 64) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) for every row of ``docs``."""
    rows = mix(docs, seed, shards, blocks_per_shard)
    taken = F.col("size") * F.coalesce(F.size("draws"), F.lit(0)).cast("long")
    rows = rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(F.col("draws").isNull(), F.lit(0)).otherwise(taken).cast("long").alias("taken"),
        F.coalesce(F.transform("draws", lambda x: x["shard"]), F.array().cast("array<int>")).alias("shards"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    return rows.drop("copy")


def mixed(docs: DataFrame, seed: int = 7, shards: int = 64, blocks_per_shard: int = 64) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are drawn, one shard beside the other, shuffled within shards."""
    plan = mix(docs, seed, shards, blocks_per_shard).where("times > 0")
    plan = plan.select(F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("text_hash").alias("m_hash"), F.col("draws").alias("m_draws"))
    ours = [free_name(docs, n) for n in ("mix_id", "mix_source", "mix_hash")]
    keyed = docs.withColumns(
        {ours[0]: F.col("doc_id").cast("long"), ours[1]: F.col("source").cast("string"), ours[2]: F.xxhash64(text_column())}
    )
    sides = [same(F.col(a), F.col(b)) for a, b in zip(ours, ("m_id", "m_source", "m_hash"))]
    rows = keyed.join(plan, sides).select(*docs.columns, F.explode("m_draws").alias(ours[0])).withColumn(ours[1], F.col(ours[0])["shard"])
    rows = rows.repartition(min(shards, partitions(docs.sparkSession)), ours[1])
    return rows.sortWithinPartitions(ours[1], F.col(ours[0])["place"]).select(*docs.columns)
