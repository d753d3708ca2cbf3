"""The radix tree against a dictionary and the trie against a plain one of nested dictionaries."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regional_balance.llm import conversation_trie as T
from regional_balance.llm.radix_tree import Full, Indexed, RadixTree, Sorted


@given(st.dictionaries(st.binary(max_size=6), st.integers(1, 99), max_size=400))
@settings(max_examples=150, deadline=None)
def test_tree_is_a_dictionary(values):
    tree = RadixTree()
    for key, value in values.items():
        tree.insert(key, value)
    assert all(tree.get(key) == value for key, value in values.items())
    assert tree.get(b"absent-key") is None
    assert sum(node.value is not None for node, _, _ in tree.bottom_up()) == len(values)


def test_layouts_grow_and_keep_order():
    kinds = []
    tree = RadixTree()
    for n, byte in enumerate(reversed(range(256)), 1):
        tree.insert(bytes([byte, 1, 2]), n)
        if n in (4, 5, 16, 17, 48, 49):
            kinds.append((type(tree.root.layout), getattr(tree.root.layout, "room", None)))
    assert kinds == [(Sorted, 4), (Sorted, 16), (Sorted, 16), (Indexed, None), (Indexed, None), (Full, None)]
    assert [b for b, _ in tree.root.layout.items()] == list(range(256))
    assert [len(node.path) for node, _, _ in tree.bottom_up()][:2] == [2, 2]


def brute(rows, rebuild):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    ids = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()[:32]
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: (x[0], x[1], ids(x[2], x[3])))] for c, v in convs.items()}
    built = own
    if rebuild:
        built = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            base = c - (c % 5 if c >= 0 else -(-c % 5))
            built[c] = own.get(base, [])[:h] + turns[h:]
    members, ending, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        ending[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in below)
    return sorted(
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else -(2**63),
            len(m),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ending[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def result(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-(2**63) if r[c] is None else r[c] for c in columns) for r in df.collect())


def rebuilt(df):
    return T.trie_nodes(T.keys(T.with_shared_heads(T.turn_lists(df))))


def listed(df):
    return [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]


def test_conversations(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert result(rebuilt(df)) == brute(listed(df), True)
    assert result(T.conversation_trie(df)) == brute(listed(df), False)


SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, part int, node_id string"


def odd_rows():
    rows = [(c, t, "user" if t % 2 else None, f"turn {t}" if t else None) for c in range(40) for t in range(c % 7)]
    rows += [(100 + c, t, "user", "same" * t) for c in range(300) for t in range(4)]  # copies
    rows += [(1000 + c, t, "user", f"deep {t}") for c in range(30) for t in range(60 + c)]  # each a beginning of the next
    rows += [(2000 + c, 0, "system", "one first turn") for c in range(90)]
    rows += [(2000 + c, 1, "user", f"then {c}") for c in range(60)]
    rows += [(3, None, "user", "no number"), (3, 2, "user", "again"), (3, 2, "user", "again"), (None, 1, "user", "nobody's"), (-7, 1, "user", "ä" * 9), (-5, 1, "a", "b")]
    rows += [(5000, t, "user", "x" * (t % 11)) for t in range(3000)]  # one very long conversation
    rows += [(5001, 0, "user", "long " * 60_000), (5002, 0, "user", ""), (5002, 1, "", "user")]
    return [(*r, "k", 1, 2, "n") for r in rows]


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_odd_rows_in_many_ranges(spark, ranges, rebuild):
    """Ranges end within copies, chains of beginnings and one first turn's children."""
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = result(rebuilt(df) if rebuild else T.conversation_trie(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(listed(df), rebuild)


def test_empty_table(spark):
    assert rebuilt(spark.createDataFrame([], SCHEMA)).count() == 0
