"""The prefix forest against brute force: recall, exact scores, ranks and ties."""

import math

import numpy as np
import pytest

from regional_balance.llm import prefix_forest as P

COLUMNS = ("query_id", "rank", "vec_id", "score")


def result(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def brute(rows, every=20, k=20):
    """Smallest vector of each id, then every product."""
    kept = {}
    for ident, v in rows:
        if ident is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = tuple(float(np.float64(x)) for x in v)
        kept[ident] = min(kept.get(ident, v), v)
    out = {}
    for q, v in kept.items():
        if q % every == 0:
            scored = [(-(np.array(w) * np.array(v)).sum(), i) for i, w in kept.items() if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def compare(got, want, least, k=20):
    """Ranks are gapless and in order, scores are exact, and at least a share of the true neighbours is found."""
    found = {}
    for q, rank, vec, score in got:
        assert rank == len(found.setdefault(q, [])) + 1
        found[q].append((vec, score))
    assert set(found) == {q for q, near in want.items() if near}
    hits = total = 0
    for q, near in want.items():
        mine = found.get(q, [])
        assert len(mine) == len(near)
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0]))
        truth = dict(near)
        assert all(abs(truth[v] - s) < 1e-12 for v, s in mine if v in truth)
        hits += sum(v in truth for v, _ in mine)
        total += len(near)
    assert hits >= least * total
    return hits / total


@pytest.mark.parametrize("rows", [8192, 60])
def test_recall_on_embeddings(spark, sf, monkeypatch, rows):
    """In one block, and in many with queries that search blocks they are not in."""
    monkeypatch.setattr(P, "BLOCK_ROWS", rows)
    monkeypatch.setattr(P, "QUERY_ROWS", 7)
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()])
    compare(result(P.nearest_vectors(df)), want, 0.9)


def test_recall_with_norms_and_copies(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ROWS", 700)
    draw = np.random.default_rng(5)
    vectors = draw.standard_normal((3000, 24)) * draw.lognormal(0, 0.7, (3000, 1))
    vectors[::3] = vectors[0]  # a third are copies
    vectors[1:600:3] = vectors[1] + draw.standard_normal((200, 24)) * 0.01  # near copies
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got, want = result(P.nearest_vectors(df)), brute(rows)
    compare(got, want, 0.9)
    # All copies tie: the smallest ids come first.
    assert [v for q, _, v, _ in got if q == 60][:3] == [v for v, _ in want[60]][:3]


ODD = [
    (None, [1.0, 2.0]), (0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, [float("nan"), 1.0]), (60, [1.0, None]), (80, None), (100, [1.0, 1.0]),
    (100, [1.0, 1.0]), (100, [0.5, 3.0]), (3, [float("inf"), 1.0]), (5, [2.0, 0.0]), (7, [2.0, 0.0]), (-20, [-1.0, 0.0]), (120, [1.0, 2.0, 3.0]), (9, []), (140, [5.0]),
    (11, [1e-30, 0.0]), (2**62, [0.0, 4.0]),
]


def test_odd_rows(spark):
    rows = [(i, v, "x", 1, 2.0, "d") for i, v in ODD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id string, rank int, score double, block string").repartition(3)
    got, want = result(P.nearest_vectors(df, miss=1e-9)), brute(ODD)
    assert [(q, r, v) for q, r, v, _ in got] == sorted((q, r, v) for q, near in want.items() for r, (v, _) in enumerate(near, 1))
    assert P.nearest_vectors(df.limit(0)).count() == 0
    assert set(P.nearest_vectors(df).columns) == set(COLUMNS)


def test_ranges_and_depths():
    codes = np.array([[0b1010 << 60], [0b1011 << 60], [0b0001 << 60]], np.uint64)
    block = P.Block(np.arange(3), np.eye(3), codes)
    asked = np.array([[0b1010 << 60 | 1]], np.uint64)
    assert block.depths(asked).tolist() == [63]
    for bits, want in ((64, 0), (63, 1), (4, 1), (3, 2), (1, 2), (0, 3)):
        starts, ends = block.ranges(asked, np.array([bits]))
        assert len(block.candidates(starts[0], ends[0])) == want


def test_last_step_bounds_the_miss():
    for cosine in (-0.9, 0.0, 0.2, 0.4, 0.99, 1.0):
        bits = int(P.last_step(np.array([cosine]), 40, 0.04)[0])
        p = float(P.agreement(np.array([cosine]))[0])
        assert bits == 0 or (1 - p**bits) ** 40 <= 0.0401
        assert bits == P.BITS or (1 - p ** (bits + 1)) ** 40 > 0.0399
