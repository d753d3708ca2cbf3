"""Fingerprints against a plain walk over the ordered documents."""

import hashlib
import random
from collections import Counter

import pytest

from regional_balance.llm import fingerprints as fp


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()), reverse=True)
    out = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        new = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, changed, following = fp.chunks(text), fp.chunks(new), fp.chunks(after)
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), fp.packed(own), fp.packed(changed), fp.containment(own, changed), fp.containment(own, following), len(own)))
    return Counter(out)


@pytest.mark.parametrize("name", ["odd", "documents", "none"])
def test_neighbours(name, request, listed):
    df = request.getfixturevalue(name)
    rows = listed(df)
    assert Counter(map(tuple, fp.compare_neighbours(df).collect())) == expected(rows)


def test_one_row(spark):
    df = spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")
    assert fp.compare_neighbours(df).first().edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_chunks_cover_the_text_and_resist_shifts():
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefgh ij") for _ in range(20_000))
    ends = fp.chunk_ends(text.encode())
    lengths = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(text) and max(lengths) <= fp.MOST and min(lengths[:-1]) >= fp.LEAST
    shifted = fp.chunks("zz" + text[:9000] + "!" + text[9000:])
    assert fp.containment(fp.chunks(text), shifted) > 0.95
    assert fp.unpacked(fp.packed(shifted)) == shifted


def test_gear_hash_is_the_rolling_sum():
    raw = random.Random(1).randbytes(300)
    value, out = 0, []
    for b in raw:
        value = ((value << 1) + int(fp.GEAR[b])) % 2**32
        out.append(value)
    assert fp.gear_hash(raw).tolist() == out


def test_containment_edges():
    assert fp.containment({}, {}) == 1.0 and fp.containment({1: 5}, {}) == 0.0 and fp.containment({}, {1: 2}) == 1.0
    assert fp.chunk_ends(b"") == [] and fp.chunk_ends(b"a") == [1]
