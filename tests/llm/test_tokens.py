"""Token operators against the libraries, and exact round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from regional_balance.llm import bpe, token_counts, token_files

LETTERS = "abcdeé ÀñΣσς.,'İıß́é \t\n\x1c\x85１2²½Ⅷ中文字😀_-s't ​　"


def odd_texts(n, longest=20, seed=1):
    rnd = random.Random(seed)
    ends = ["", "", "<|endoftext|>", " <|startoftext|> x", "   "]
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, longest))) + rnd.choice(ends) for _ in range(n)]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def test_counter_equals_library(words):
    count = token_counts.PrefixCounter(P.path("word_bpe_49k.json"))
    for text in odd_texts(4000):
        assert sum(count.counts(count.words(text))) == len(words.encode(text, add_special_tokens=False).ids), text


def test_every_prefix_of_a_word(words):
    count = token_counts.PrefixCounter(P.path("word_bpe_49k.json"))
    rnd = random.Random(2)
    pieces = ["internationalization", "thblewhthe", *("".join(rnd.choice("abehinotrs") for _ in range(rnd.randint(1, 25))) for _ in range(200))]
    for w in pieces:
        assert count.prefix_counts(w) == [len(words.encode(w[: i + 1], add_special_tokens=False).ids) for i in range(len(w))], w


def test_budget(words):
    count = token_counts.PrefixCounter(P.path("word_bpe_49k.json"))
    text = "reading the thblewhthe, internationalization of harbours. " * 5
    for budget in (0, 1, 7, 30, 10**6):
        n, part = count.within(text, budget)
        whole = text.split()
        cut = " ".join(whole[:n]) + (" " + whole[n][:part] if part else "")
        assert len(words.encode(cut, add_special_tokens=False).ids) <= budget
        if n < len(whole):
            longer = " ".join(whole[: n + 1])
            assert len(words.encode(longer, add_special_tokens=False).ids) > budget


@pytest.mark.parametrize("name", ["odd", "documents", "none"])
def test_count_tokens(name, request, listed, words):
    df = request.getfixturevalue(name)
    want = Counter()
    for d, t in listed(df):
        n = len(words.encode(t or "", add_special_tokens=False).ids)
        want[d, len((t or "").encode()), n, n > 300] += 1
    got = token_counts.count_tokens(df, P.path("word_bpe_49k.json"), limit=300).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_encoder_equals_library():
    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files.Encoder(path)
    for text in odd_texts(4000, seed=4):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_texts_encoded_together():
    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files.Encoder(path)
    known = ["ÀÉÿ×é", "a'b'", "x^_`{|}~", "naïve's...", "ﬁne,", "été.\nÊtre,", "word--", "º.", "\nword", ""]
    rnd = random.Random(7)
    texts = odd_texts(300, seed=6) + [" ".join(rnd.choices(known, k=6)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(["unread", *texts])], ["text"]).slice(1)
    for size in (1, 200, 1 << 20):
        parts = list(token_files.portions(batch, "text", size))
        listed = [part.column("text").to_pylist() for part in parts]
        assert sum(listed, []) == texts
        assert all(len(some) == 1 or sum(len(x.encode()) for x in some) <= size for some in listed)
        got = [np.frombuffer(ids, "<u4").tolist() for part in parts for ids in own.encode_all(part.column("text"))]
        assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_marks_do_not_make_a_word_new():
    """Each pre-token goes to the library's model once, whatever stands after it in a text."""
    own = token_files.Encoder(P.path("byte_bpe_50k.json"))
    asked, model = [], own.words.pieces.tokenize
    own.words.pieces.tokenize = lambda shown: asked.append(shown) or model(shown)
    own.encode_all(pa.array(["An anthle, anthle. anthle\nthen anthle; été, été.", "An anthle,\nthen"]))
    assert sorted(asked) == sorted(["An", "Ġanthle", ",", ".", "Ċ", "then", ";", "ĠÃ©tÃ©"])


def test_directly_addressable_codes():
    rnd = random.Random(3)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = np.array([rnd.choice([0, 3, 255, 256, 50_000, 70_000, 2**32 - 1]) for _ in range(n)], np.uint32)
        image = b"xy" + token_files.pack(ids)
        assert token_files.unpack(image, 2).tolist() == ids.tolist()
        assert [token_files.access(image, i, 2) for i in range(n)] == ids.tolist()
    with pytest.raises(IndexError):
        token_files.access(token_files.pack(np.array([1, 2])), 2)


@pytest.mark.parametrize("name", ["odd", "documents", "none"])
@pytest.mark.parametrize("segment", [500, 1 << 20])
def test_token_files(name, segment, request, listed):
    df = request.getfixturevalue(name)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = []
    for d, t in listed(df):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        rows.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = token_files.read_token_files(token_files.write_token_files(df, P.path("byte_bpe_50k.json"), 0, segment)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(rows)
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == [sum(r.n_tokens for r in order[:i]) for i in range(len(order))]
    ids = [(r.doc_id is None, r.doc_id or 0) for r in order]
    assert ids == sorted(ids)


@pytest.fixture(scope="module")
def ranks():
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})


def test_parts_of_long_texts(ranks):
    for text in odd_texts(300, 300, seed=5):
        assert "".join(bpe.safe_parts(text, 7)) == text
        assert bpe.encode_text(ranks, text, 7) == ranks.encode_ordinary(text), text


@pytest.mark.parametrize("name", ["odd", "documents", "none"])
def test_round_trip(name, request, listed, ranks):
    df = request.getfixturevalue(name)
    path = P.path("byte_bpe_multi_50k.tiktoken")
    want = Counter()
    for d, t in listed(df):
        ids = ranks.encode_ordinary(t or "")
        want[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip(df, path, P.PATTERN).collect())) == want
    back = bpe.decode(bpe.encode(df, path, P.PATTERN), path, P.PATTERN)
    assert Counter((r.doc_id, bytes(r.bytes)) for r in back.collect()) == Counter((d, (t or "").encode()) for d, t in listed(df))
    assert back.columns == [*df.columns, "ids", "bytes"]
