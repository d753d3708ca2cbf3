"""Removal of repeats against a table of all windows."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import pytest

from regional_balance.llm import suffix_index, suffixes
from regional_balance.llm.queries import QUERIES


def expected(rows, length):
    seen = Counter()
    raws = [(d, (t or "").encode()) for d, t in rows]
    for _, raw in raws:
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for d, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def got(df, **options):
    rows = suffix_index.remove_repeats(df, **options).collect()
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in rows)
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


@pytest.mark.parametrize("name", ["documents", "none"])
def test_documents(name, request, listed):
    df = request.getfixturevalue(name)
    assert got(df, length=400, batches=2) == expected(listed(df), 400)


def test_odd_rows(odd, listed):
    short = [(d, t[:5000] if t else t) for d, t in listed(odd)]
    df = odd.sparkSession.createDataFrame(short, "doc_id long, text string")
    assert got(df, length=60, batches=3) == expected(short, 60)


@pytest.mark.parametrize("group", [2, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_edited_copies_in_batches(spark, monkeypatch, seed, group):
    """Copies with edits, passages inside other texts, repeats inside one text; small and large groups."""
    monkeypatch.setattr(suffix_index, "GROUP", group)
    rnd = random.Random(seed)
    new = lambda n: "".join(rnd.choice("abc é\n") for _ in range(n))
    base, passage = new(700), new(130)
    rows = []
    for i in range(60):
        text = base
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(text))
            text = text[:at] + new(rnd.randint(0, 3)) + text[at + rnd.randint(0, 2) :]
        kind = rnd.randrange(4)
        text = [text, new(300) + passage + new(50), text[rnd.randrange(300) :], passage[:99] + new(40) + passage[20:]][kind]
        rows.append((i, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 5):
        assert got(df, length=100, batches=batches) == expected(rows, 100)


def passage_words(rows, length):
    """Words in windows of ``length`` words found twice or more, by doc_id and text."""
    split = [(d, t, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    windows = lambda words: [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
    seen = Counter(w for _, _, words in split for w in windows(words))
    out = []
    for d, t, words in split:
        starts = [i for i, w in enumerate(windows(words)) if seen[w] > 1]
        out.append((d, len((t or "").encode()), len({i + k for i in starts for k in range(length)})))
    return Counter(out)


def passages(df, **options):
    return Counter((r.doc_id, r.n_bytes, r.n_passage_words) for r in suffix_index.remove_repeats(df, **options).collect())


def test_passages_of_documents(documents, listed):
    assert passages(documents) == passage_words(listed(documents), 50)


def test_passages_of_odd_rows(odd, listed):
    assert passages(odd, words=8, batches=3) == passage_words(listed(odd), 8)


@pytest.mark.parametrize("group", [2, 4096])
def test_edited_passages_in_batches(spark, monkeypatch, group):
    """Few different words, edits and other white space in copies; small and large groups."""
    monkeypatch.setattr(suffix_index, "GROUP", group)
    rnd = random.Random(group)
    new = lambda n: [rnd.choice(["a", "bé", "cdd", "e1"]) for _ in range(n)]
    base, rows = new(80), []
    for i in range(60):
        words = base[rnd.randrange(20) : 80 - rnd.randrange(20)]
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = rnd.choice(["x", "a", "yy"])
        words = [words, new(30) + words + new(5), words + words[3:]][rnd.randrange(3)]
        rows.append((i, "".join(w + rnd.choice([" ", "\n", " \t "]) for w in words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 5):
        assert passages(df, words=14, batches=batches) == passage_words(rows, 14)


def test_passages_of_short_words_are_told(spark):
    """51 shared words take fewer bytes than a window: none is removed, all are counted, and lone texts have none."""
    rnd = random.Random(7)
    new = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=4)) for _ in range(n))
    passage = new(51)
    rows = [(i, f"{new(60)} {passage} {new(60)}") for i in range(20)] + [(100 + i, new(170)) for i in range(20)]
    got = suffix_index.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(passage) < 400 and all(r.n_removed == 0 for r in got)
    assert {r.doc_id: r.n_passage_words for r in got} == {d: 51 if d < 100 else 0 for d, _ in rows}


def test_word_stretches(monkeypatch):
    raw = " ".join(random.Random(8).choices(["a", "b", "cc"], k=900)).encode()
    whole = {w: a for f, x, a in suffixes.word_runs(raw, 20)[0] for w in range(f, x + 1)}
    monkeypatch.setattr(suffixes, "STRETCH", 200)
    assert sorted(whole) == list(range(881))
    assert whole == {w: a for f, x, a in suffixes.word_runs(raw, 20)[0] for w in range(f, x + 1)}


def test_anchors_depend_on_windows_alone():
    rnd = random.Random(5)
    shared = bytes(rnd.choice(b"abcd") for _ in range(900))
    places = []
    for before in (b"", b"zzzzz", bytes(rnd.choice(b"abcd") for _ in range(333))):
        raw = before + shared + b"yy"
        at = {w: a - w for f, x, a in suffixes.anchored_runs(raw, 100) for w in range(f, x + 1)}
        assert sorted(at) == list(range(len(raw) - 99))
        places.append([at[len(before) + i] for i in range(len(shared) - 99)])
    assert places[0] == places[1] == places[2]


def test_stretches(monkeypatch):
    raw = bytes(random.Random(6).choices(b"abcdef", k=3000))
    whole = {w: a for f, x, a in suffixes.anchored_runs(raw, 50) for w in range(f, x + 1)}
    monkeypatch.setattr(suffixes, "STRETCH", 700)
    assert whole == {w: a for f, x, a in suffixes.anchored_runs(raw, 50) for w in range(f, x + 1)}


def test_levels_merge_geometrically(spark):
    family = suffix_index.IndexFamily()
    for b in range(7):
        runs = spark.createDataFrame([(b, b, 0, 0, b, b)], "doc_id long, text_hash long, first int, last int, key long, whole long")
        family.add(runs)
    family.merge()
    assert [(size, level.count()) for size, level in family.levels] == [(4, 4), (2, 2), (1, 1)]


def test_the_query_merges_levels(spark, sf, listed, monkeypatch):
    merged, merge = [], suffix_index.IndexFamily.merge

    def watched(family):
        before = len(family.levels)
        merge(family)
        if len(family.levels) < before:
            merged.append(family.levels[-1][0])

    monkeypatch.setattr(suffix_index.IndexFamily, "merge", watched)
    rows = QUERIES["op5_suffix_index"](spark, sf).collect()
    assert merged == [2, 4]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == expected(listed(docs), 400)


def test_batches_follow_the_input(spark):
    texts = spark.createDataFrame([("é" * 500,), ("a" * 1500,)], "text string")
    assert suffix_index.batches_for(texts, 500) == 5
    assert suffix_index.batches_for(texts, 10_000) == suffix_index.batches_for(texts.limit(0), 500) == 4


def test_merged_levels_leave_no_files(spark):
    family = suffix_index.IndexFamily()
    gone = []
    for b in range(4):
        runs = spark.createDataFrame([(b, b, 0, 0, 7, b % 2)], "doc_id long, text_hash long, first int, last int, key long, whole long")
        family.add(runs)
        gone += [p for p in family.paths if p not in gone]
    path = lambda p: Path(p.removeprefix("file:"))
    assert [size for size, _ in family.levels] == [4] and len(gone) == 4
    assert [path(p).exists() for p in gone] == [p in family.paths for p in gone]
    assert sorted((r.key, r.whole, r.n) for r in family.known().collect()) == [(7, 0, 2), (7, 1, 2)]
