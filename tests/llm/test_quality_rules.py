"""Base counts against a plain count, and the robust estimate against planted outliers."""

import random
import re
from collections import Counter

import pytest

from regional_balance.llm import quality_rules as rules


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


@pytest.mark.parametrize("name", ["odd", "documents", "none"])
def test_base_counts(name, request, listed):
    df = request.getfixturevalue(name)
    want = Counter()
    for d, t in listed(df):
        s = plain(t or "")
        want[d, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]] += 1
    got = rules.quality_verdicts(df).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    kept = rules.keep_good(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_outliers_of_a_source(spark):
    """A fifth of a source is junk of one kind, so plain means and variances would hide it."""
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, n)))
    rows = []
    for i in range(600):
        words = [word(7) for _ in range(rnd.randint(60, 300))]
        if i % 5 == 0:
            words = [w + rnd.choice(["###", "$$$", " |"]) for w in words]
        rows.append((i, " ".join(words), "en", "s1" if i % 3 else "s2", i % 5 == 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")
    kept = {r.doc_id: r.kept for r in rules.quality_verdicts(df).collect()}
    assert all(kept[r[0]] != r[4] for r in rows)


def test_labelled_documents(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/labels.parquet")
    rows = rules.quality_verdicts(docs).join(labels, "doc_id").where("n_words >= 50").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)
