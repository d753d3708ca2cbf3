"""The mix against plain water-filling, and the exactness of the splitting tree."""

import re
from collections import Counter, defaultdict

import pytest

from regional_balance.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.remove(s)
        if not free:
            return target


@pytest.mark.parametrize("name", ["odd", "documents", "none"])
def test_targets_and_taken(name, request):
    df = request.getfixturevalue(name)
    rows = df.select("doc_id", "text", "source").collect()
    sizes, size_of = defaultdict(int), Counter()
    for r in rows:
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] += n
        size_of[r.doc_id, n, r.source] += 1
    target = plain_targets(sizes) if sizes else {}
    got = mixing.mixed_sizes(df, shards=4, blocks_per_shard=8).collect()
    assert len(got) == len(rows)
    source_of = {(r.doc_id, len(WORD.findall(r.text or ""))): r.source for r in rows}
    assert Counter((r.doc_id, r.size, source_of[r.doc_id, r.size]) for r in got) == size_of
    taken = defaultdict(int)
    for r in got:
        s = source_of[r.doc_id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s], rel=1e-9)
        assert r.taken <= 3 * r.size and r.taken == r.size * len(r.shards)
        taken[s] += r.taken
    if name == "documents":
        for s, t in target.items():
            assert abs(taken[s] - t) <= 0.02 * t + 100, s
    again = mixing.mixed_sizes(df.repartition(5), shards=4, blocks_per_shard=8).collect()
    assert Counter((r.doc_id, r.size, r.taken, tuple(r.shards)) for r in again) == Counter((r.doc_id, r.size, r.taken, tuple(r.shards)) for r in got)


def test_tree_is_exact(spark):
    quota = spark.createDataFrame([(0, 40), (1, 25), (2, 1), (3, 14)], "rank int, quota long")
    leaves = mixing.splitting_tree(quota, 5, 3).collect()
    by_shard, by_rank = Counter(), Counter()
    for r in leaves:
        by_shard[r.shard] += r.blocks
        by_rank[r.rank] += r.blocks
    assert by_shard == {i: 16 for i in range(5)} and by_rank == {0: 40, 1: 25, 2: 1, 3: 14}
    blocks = mixing.dealt_blocks(quota, spark.createDataFrame(leaves, "shard int, rank int, blocks long"), 3).collect()
    assert Counter((r.rank, r.block) for r in blocks) == Counter((k, b) for k, n in by_rank.items() for b in range(n))
    assert Counter(r.shard for r in blocks) == by_shard


def test_hypergeometric_follows_its_distribution(spark):
    from math import comb

    from pyspark.sql import functions as F

    n = 4000
    df = spark.range(n).select(mixing.hypergeometric(F.lit(20).cast("long"), F.lit(7).cast("long"), F.lit(9).cast("long"), (F.col("id") + 0.5) / n).alias("x"))
    got = Counter(r.x for r in df.collect())
    for k in range(8):
        assert got[k] / n == pytest.approx(comb(7, k) * comb(13, 9 - k) / comb(20, 9), abs=2 / n)


def test_mixed_rows(odd, none):
    rows = mixing.mixed(odd, shards=4, blocks_per_shard=8)
    assert rows.columns == odd.columns
    drawn = Counter((r.doc_id, r.text) for r in rows.collect())
    plan = mixing.mix(odd, shards=4, blocks_per_shard=8).collect()
    assert sum(drawn.values()) == sum(r.copies * (r.times or 0) for r in plan)
    assert mixing.mixed(none, shards=4, blocks_per_shard=8).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(odd, shards=1, blocks_per_shard=2)
