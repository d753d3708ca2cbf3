"""Each stage of the pipeline on what the one before kept, against plain Python."""

import hashlib
import re
from collections import Counter

import public_tokenizers as P
import pytest

import corpus_pipeline
from regional_balance.llm import bpe, quality_rules
from regional_balance.llm.common import store

from tests.llm.test_mixing import plain_targets
from tests.llm.test_pii import base
from tests.llm.test_simhash import plain_fingerprint, plain_groups


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_stages(spark, name, request, sf):
    docs = request.getfixturevalue(name)
    tables = [docs]
    for step, stage in corpus_pipeline.STAGES:
        tables.append(store(stage(spark, tables[-1], sf), step))
    assert all(t.columns == docs.columns for t in tables[:5])
    rows = [t.collect() for t in tables]

    verdict = {r.doc_id: r.kept for r in quality_rules.quality_verdicts(docs).collect()}
    assert Counter(r.doc_id for r in rows[1]) == Counter(r.doc_id for r in rows[0] if verdict[r.doc_id])

    fps = [plain_fingerprint(r.text or "") for r in rows[1]]
    group = plain_groups(set(fps), 4)
    order = lambda r: (r.doc_id is None, r.doc_id or 0)
    first = {}
    for r, f in zip(rows[1], fps):
        first[group[f]] = min(first.get(group[f], r), r, key=order)
    assert Counter(r.doc_id for r in rows[2]) == Counter(r.doc_id for r in first.values())

    masked = {r.doc_id: r.text for r in rows[3]}
    for r in rows[2]:
        found = [m for kind in base(r.text or "") for _, m in kind]
        assert (masked[r.doc_id] == r.text) or found or "[" in masked[r.doc_id]
        assert not any(kind for kind in base(masked[r.doc_id] or ""))

    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows[3]}
    totals, taken = Counter(), Counter()
    for r in rows[3]:
        totals[r.source] += size[r.doc_id]
    for r in rows[4]:
        taken[r.source] += size[r.doc_id]
        assert r.text == masked[r.doc_id]
    assert max(Counter(r.doc_id for r in rows[4]).values(), default=0) <= 3
    if name == "documents":
        for s, t in plain_targets(totals).items():
            assert abs(taken[s] - t) <= 0.05 * t + 100

    enc = bpe.encoding(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    want = Counter()
    for r in rows[4]:
        ids = enc.encode_ordinary(r.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows[5]) == want


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_empty(spark, none, sf):
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, sf)
    assert none.count() == 0
