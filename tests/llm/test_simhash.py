"""SimHash groups against all pairs, and their plans for groups of near copies."""

import random
import re
from collections import Counter

import pytest
import xxhash

from regional_balance.llm import simhash


def plain_fingerprint(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, distance):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nodes = sorted(parent)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    return {f: find(f) for f in nodes}


@pytest.mark.parametrize("name", ["odd", "documents", "none"])
def test_groups(name, request, listed):
    df = request.getfixturevalue(name)
    rows = [(d, plain_fingerprint(t or "")) for d, t in listed(df)]
    group = plain_groups({f for _, f in rows}, 4)
    least = {}
    for d, f in rows:
        if d is not None:
            least[group[f]] = min(d, least.get(group[f], d))
    want = Counter((d, format(f, "016x"), least.get(group[f])) for d, f in rows)
    got = simhash.simhash_groups(df)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert len(kept.collect()) == len(set(group.values()))


@pytest.mark.parametrize("seed", range(4))
def test_balls_and_chains_of_fingerprints(spark, seed):
    """Dense balls, chains with steps of up to four bits, strays at five bits and random values."""
    rnd = random.Random(seed)
    flip = lambda f, n: f ^ sum(1 << b for b in rnd.sample(range(64), n))
    values = {rnd.getrandbits(64) for _ in range(150)}
    for _ in range(3):
        centre = rnd.getrandbits(64)
        values |= {flip(centre, rnd.randint(0, 7)) for _ in range(120)}
        at = centre
        for _ in range(30):
            at = flip(at, rnd.choice([3, 4, 5]))
            values.add(at)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = simhash.store(spark.createDataFrame([(signed(f),) for f in values], "fp long"), "test")
    got = {r.fp: r.comp for r in simhash.linked(df, 4).collect()}
    want = plain_groups(values, 4)
    assert len(got) == len(values)
    for part in ({(signed(f), signed(g)) for f, g in want.items()}, set(got.items())):
        assert len(part) == len(values)
    by_want, by_got = {}, {}
    for f in values:
        by_want.setdefault(want[f], set()).add(signed(f))
        by_got.setdefault(got[signed(f)], set()).add(signed(f))
    assert sorted(map(sorted, by_want.values())) == sorted(map(sorted, by_got.values()))


@pytest.mark.parametrize("blocks", range(5, 10))
def test_close_pairs_share_a_key(spark, blocks):
    from pyspark.sql import functions as F

    rnd = random.Random(blocks)
    rows = []
    for _ in range(200):
        a = rnd.getrandbits(64)
        b = a ^ sum(1 << x for x in rnd.sample(range(64), 4))
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(rows, "a long, b long")
    keys = [simhash.block_keys(F.col(c), blocks, 4) for c in "ab"]
    assert df.where(~F.arrays_overlap(*keys)).count() == 0


def test_block_plan_follows_the_count():
    assert simhash.block_plan(10, 4) == 5 < simhash.block_plan(10**7, 4) <= simhash.block_plan(10**9, 4)
