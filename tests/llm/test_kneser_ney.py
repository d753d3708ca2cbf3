"""The model against a plain recursive one, its two ways of scoring, and held-out labels."""

import math
import random
from collections import Counter, defaultdict

import pytest

from regional_balance.llm import kneser_ney as kn


def plain_model(texts):
    """Interpolated modified Kneser-Ney of order four over characters: a function from 4-gram to probability."""
    counts = {4: Counter()}
    for t in texts:
        chars = [2, 2, 2, *(min(ord(c), 0xFFFF) for c in t), 3]
        counts[4].update(tuple(chars[i : i + 4]) for i in range(len(chars) - 3))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    unknown = 1 / (len(counts[1]) + 1)
    discounts, contexts = {}, {}
    for k, c in counts.items():
        n = Counter(c.values())
        d = []
        for i in (1, 2, 3):
            if n[1] and n[2] and n[i]:
                d.append(max(0.1, min(i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i], float(i))))
            else:
                d.append(0.5)
        discounts[k] = d
        contexts[k] = defaultdict(lambda: [0, 0.0])
        for g, m in c.items():
            contexts[k][g[:-1]][0] += m
            contexts[k][g[:-1]][1] += d[min(m, 3) - 1]

    def p(g):
        if not g:
            return unknown
        k = len(g)
        ctx = contexts[k].get(g[:-1])
        if ctx is None:
            return p(g[1:])
        m = counts[k].get(g, 0)
        share = max(m - discounts[k][min(m, 3) - 1], 0) / ctx[0] if m else 0
        return share + ctx[1] / ctx[0] * p(g[1:])

    return p, counts


def logp(p, t):
    chars = [2, 2, 2, *(min(ord(c), 0xFFFF) for c in t), 3]
    return sum(math.log(p(tuple(chars[i : i + 4]))) for i in range(len(chars) - 3)), len(chars) - 3


@pytest.mark.parametrize("bound", [4_000_000, 0])
def test_equals_plain_model(spark, bound):
    rnd = random.Random(2)
    text = lambda: "".join(rnd.choice("ab ab cdé") for _ in range(rnd.randint(0, 60)))
    rows = [(i, text() + ("😀" if i % 7 == 0 else ""), "en" if i % 2 else "de") for i in range(80)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "zzz", "fr"), (203, "abc", None), (1, "twice", "en"), (1, "twice", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(40)] + [(3,), (None,)], "doc_id long")
    got = kn.perplexities(df, trusted, bound).collect()
    assert len(got) == len(rows)
    want = {}
    for lang in ("en", "de"):
        p, _ = plain_model([t for i, t, x in rows if x == lang and i < 40])
        for i, t, x in rows:
            if x == lang:
                total, n = logp(p, t or "")
                want[i, n] = math.exp(-total / n)
    for r in got:
        if r.lang in ("fr", None):
            assert r.perplexity is None
        else:
            assert r.perplexity == pytest.approx(want[r.doc_id, r.n_grams], rel=1e-9)


def test_probabilities_of_a_context_add_up():
    p, counts = plain_model(["abca bcab", "cabba ca", "bb"])
    letters = {g[-1] for g in counts[1]}
    for ctx in {g[:-1] for g in counts[4]}:
        assert sum(p((*ctx, c)) for c in letters) + p((*ctx, 999)) == pytest.approx(1.0)


@pytest.mark.parametrize("name", ["odd", "none"])
def test_odd_rows(spark, name, request):
    df = request.getfixturevalue(name)
    trusted = spark.createDataFrame([(5,), (6,), (8,), (5,)], "doc_id long")
    got = kn.classify(df, trusted).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in df.collect())
    assert all(r.kept for r in got if r.threshold is None)


def test_held_out_labels(spark, sf):
    folder = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    trusted = labels.where("quality = 1 AND toxic = 0 AND doc_id % 2 = 0").select("doc_id")
    rows = kn.classify(docs, trusted).join(labels, "doc_id").where("doc_id % 2 = 1").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.4 * len(bad)


def test_threshold_is_the_quantile_of_held_out_texts(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = docs.join(labels.where("quality = 1 AND toxic = 0"), "doc_id").selectExpr("doc_id", f"pmod(xxhash64(text), {kn.FOLDS}) AS fold").cache()
    found = {}
    for f in range(kn.FOLDS):
        for r in kn.perplexities(docs, good.where(f"fold <> {f}")).join(good.where(f"fold = {f}"), "doc_id").collect():
            found.setdefault(r.lang, []).append(r.perplexity)
    edges = {r.lang: r.threshold for r in kn.classify(docs, good, quantile=0.9).collect()}
    for lang, own in found.items():
        assert edges[lang] == pytest.approx(sorted(own)[math.ceil(0.9 * len(own)) - 1], rel=1e-9)


def test_rates_on_unseen_labels(spark, sf):
    folder = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    trusted = labels.where("quality = 1 AND toxic = 0 AND doc_id % 2 = 0").select("doc_id")
    rows = kn.classify(docs, trusted).join(labels, "doc_id").where("doc_id % 2 = 1").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.25 * len(bad)
