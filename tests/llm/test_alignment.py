"""Token alignment against plain whole-text encoding and set intersection."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from regional_balance.llm import alignment

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)))
@settings(max_examples=200, deadline=None)
def test_gallop_is_intersection(a, b):
    x, y = sorted(a), sorted(b)
    assert [(x[i], y[j]) for i, j in alignment.common_ends(x, y)] == [(v, v) for v in sorted(a & b)]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute(rows, libraries):
    """Whole texts through the libraries, ends as sets, counts in dictionaries."""
    a, b = libraries
    alphabet = alignment.byte_alphabet()
    parts, counts = [], Counter()
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            parts.append((doc_id, 0, 0, [], []))
            continue
        groups, group_a, group_b, links = [], [], [], []
        ends_b, at, k = {}, 0, 0
        for k, x in enumerate(bytes_b):
            at += len(x)
            ends_b[at] = k
        at = start = 0
        for i, x in zip(ids_a, bytes_a, strict=True):
            group_a.append(i)
            at += len(x)
            if at in ends_b:
                group_b = ids_b[start : ends_b[at] + 1]
                start = ends_b[at] + 1
                groups.append(f"{','.join(map(str, group_a))}|{','.join(map(str, group_b))}")
                links.append((i, group_b[-1]))
                group_a = []
        counts.update(links)
        parts.append((doc_id, len(ids_a), len(ids_b), groups, links))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, n_a, n_b, groups, links in parts:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=str)


def result(df):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_documents(documents, libraries, listed):
    assert result(alignment.align_tokenizers(documents, BYTES, PIECES)) == brute(listed(documents), libraries)


def test_odd_rows_in_small_chunks(odd, none, libraries, listed, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 500)
    got = result(alignment.align_tokenizers(odd, BYTES, PIECES))
    assert got == brute(listed(odd), libraries)
    assert alignment.align_tokenizers(none, BYTES, PIECES).count() == 0


TRICKY = ["", " ", "  a", "a  ", "\n \t x", "a▁b", "it's 12 34", "x\x1c y\x85 z", "  nb", "﻿bom ​ zero", "<s> </s> <unk> <|endoftext|> <0x0A>", "é ﬁ ½"]


@given(st.lists(st.sampled_from([*TRICKY, "The", "é", "中文", "😀", ".", "don't", "\r\n"]), max_size=12).map(" ".join))
@settings(max_examples=150, deadline=None)
def test_units_are_whole_texts(libraries, text):
    work = alignment.aligner(BYTES, PIECES)
    assert work.in_units and work.by_rank is not None
    [(n_a, n_b, n_groups, digest, pairs)] = work.documents([text])
    [(_, *want)] = brute([(0, text)], libraries)
    assert [n_a, n_b, n_groups, len(pairs) // 8, digest] == [*want[:3], want[3], want[-1]]


def test_long_text_without_spaces(libraries):
    work = alignment.aligner(BYTES, PIECES)
    [(_, *want)] = brute([(0, "x" * 60_000)], libraries)
    assert work.documents(["x" * 60_000])[0][3] == want[-1]


def test_remembered_units_change_nothing(documents, libraries, listed, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    rows = listed(documents)[:40]
    work = alignment.Aligner(BYTES, PIECES)
    got = [work.documents([text or ""])[0] for _, text in rows]
    want = {r[0]: r for r in brute([(i, text) for i, (_, text) in enumerate(rows)], libraries)}
    assert [(g[0], g[1], g[2], g[3]) for g in got] == [(want[i][1], want[i][2], want[i][3], want[i][7]) for i in range(len(rows))]


def test_tokenizers_get_portions_and_tasks_forget(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "PORTION_CHARS", 200)
    work, sizes = alignment.Aligner(BYTES, PIECES), []
    plain = work.groups
    monkeypatch.setattr(work, "groups", lambda spaced: sizes.append(len(spaced)) or plain(spaced))
    text = " ".join(f"w{i}" for i in range(2000)) + " " + "y" * 500
    [(_, *want)] = brute([(0, text)], libraries)
    assert work.documents([text])[0][3] == want[-1]
    assert len(sizes) > 10 and sorted(sizes)[-2] <= 201 and max(sizes) == 501
    assert work.seen
    work.forget()
    assert not work.seen and not work.before


def test_chunks_are_small_rows(documents, libraries, listed, monkeypatch):
    monkeypatch.setattr(alignment, "PAIRS", 7)
    one = documents.limit(60).coalesce(1)
    chunks = alignment.aligned_chunks(one, BYTES, PIECES).collect()
    docs, pairs = [r for r in chunks if r.links is not None], [r for r in chunks if r["keys"] is not None]
    assert len(docs) == 60 and len(docs) + len(pairs) == len(chunks) and all(len(r.links) == 4 * r.n_groups for r in docs)
    assert all(0 < len(r["keys"]) == len(r.times) <= 7 for r in pairs)
    assert [r.first for r in pairs] == list(range(0, 7 * len(pairs), 7)) and sum(sum(r.times) for r in pairs) == sum(r.n_groups for r in docs)
    assert result(alignment.align_tokenizers(one, BYTES, PIECES)) == brute(listed(one), libraries)
