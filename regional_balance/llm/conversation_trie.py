"""The prefix trie of conversations: which beginnings they share, and what a cache of them would save.

A turn (role and text) gets an id of 16 bytes, the beginning of a SHA-256; a conversation's key is its ids one after another.
Texts stay behind after that. Keys are range-partitioned in byte order, equal ones by conversation id as well, so that
neither a common beginning nor a group of copies has to fit one task. Each range is one adaptive radix tree
(``radix_tree``), read from the leaves up: byte depths at a whole number of ids are the trie's nodes, also inside a
compressed path.

A node that is not on the path to the first or the last key of its range lies in that range alone and is final, but for
its parent's name. The two paths (``spines``) may go on in other ranges: their nodes come as partial sums, are added up by
node, and are corrected for what ranges can't know (members of several ranges count one node's text once, a key at the end
of a range may have children in the next). A correction belongs to one spine and is summed upwards along it, so the
work on spines grows with their length and not with its square.

Rows without a conversation id belong to no conversation. Turns of a conversation with the same number, repeated
rows among them, all stay, in the order of their ids. A null role or text is empty. An empty table has no nodes. Other columns are not read.
One conversation's key, 16 bytes a turn, is one value of a row, however long its texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regional_balance.llm.common import partitions, stored
from regional_balance.llm.radix_tree import RadixTree

WIDTH = 16  # bytes of a turn id

#: Bytes of keys in a range, about: bounds a task's tree.
RANGE_BYTES = 8 << 20

_ROWS = 20_000
_NOTHING = hashlib.sha256(b"").hexdigest()

#: ``spine`` is 0 for final nodes, 1 and 2 for those on the way to a range's first and last key. ``again`` marks nodes of
#: the second path that are on the first as well; they hold no sums. ``leaf`` is 1 for a node without children in its range.
_NODES = (
    "part long, spine int, again boolean, node_id binary, parent_id binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, n_bytes long, leaf long, first_end long, ends string"
)
_NAMES = [c.split()[0] for c in _NODES.split(", ")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order (null first), as (id in hex, bytes of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    known = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.col("turn").cast("long")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            turn.isNotNull().alias("numbered"),
            F.coalesce(turn, F.lit(0)).alias("turn"),
            F.substring(F.sha2(known, 256), 1, 2 * WIDTH).alias("id"),
            F.octet_length(text).alias("size"),
        ).alias("t"),
    )
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def with_shared_heads(lists: DataFrame, every: int = 5, below: int = 9) -> DataFrame:
    """Conversations rebuilt on a neighbour's beginning: the first h turns of conversation ``c - c % every`` (none if it
    is absent) and then c's own turns after its first h, where h is the CRC-32 of c in decimal modulo ``below``."""
    c = F.col("conv_id")
    heads = lists.filter(c % every == 0).select(c.alias("base"), F.slice("turns", 1, below).alias("head"))
    own = lists.withColumns({"base": c - c % every, "h": (F.crc32(c.cast("string")) % below).cast("int")}).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.select("conv_id", F.concat(head, rest).alias("turns"))


def keys(lists: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): ids as one binary value, and the text bytes of each turn."""
    ids = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    return lists.select("conv_id", F.unhex(ids).alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


class Range:
    """The trie nodes of one range of keys, that come in order."""

    def __init__(self, part: int):
        self.part, self.tree, self.first, self.last, self.n = part, RadixTree(), b"", b"", 0

    def add(self, key: bytes, sizes: list[int], convs: list[int]) -> None:
        self.first = key if self.n == 0 else self.first
        self.last = key
        self.tree.insert(key, (self.n, sizes, len(convs), min(convs), convs[0], ",".join(map(str, convs))))
        self.n += 1

    @staticmethod
    def _spine(key: bytes) -> list[bytes]:
        """Ids of the nodes on the way to a key: each is a digest of the one before and the turn."""
        out = [bytes(WIDTH)]
        for at in range(0, len(key), WIDTH):
            out.append(hashlib.blake2b(out[-1] + key[at : at + WIDTH], digest_size=16).digest())
        return out

    def nodes(self) -> Iterator[tuple]:
        """Rows of ``_NODES``."""
        spines = {1: self._spine(self.first), 2: self._spine(self.last)}
        rows: list[list] = []
        below: dict[int, tuple] = {}

        def emit(depth, low, high, n, smallest, children, leaves, saved, sizes, ends) -> tuple:
            size = sizes[depth - 1] if depth else 0
            leaves, saved = (leaves if children else 1), saved + (n - 1) * size
            on = [k for k, hit in ((1, low == 0), (2, high == self.n - 1)) if hit]
            name = spines[on[0]][depth] if on else None
            closed = 0
            for child in children:
                if on:
                    rows[child][4] = name
                    closed += rows[child][1] == 0
                else:
                    rows[child][7] = smallest
            first_end, text = ends or (None, None)
            if not on:
                text = hashlib.sha256(text.encode()).hexdigest() if ends else _NOTHING
            kept = closed if on else len(children)
            # ``again`` holds the second spine here if the node is on both.
            rows.append([self.part, on[0] if on else 0, len(on) == 2, name, None, smallest, depth, None, n, kept, leaves, saved, size, int(not children), first_end, text])
            return [len(rows) - 1], leaves, saved

        for node, top, end in self.tree.bottom_up():
            low, high, n, smallest, children, leaves, saved, sizes, ends = self.n, -1, 0, None, [], 0, 0, None, None
            if node.value is not None:
                low, sizes, n, smallest, first_end, text = node.value
                high, ends = low, (first_end, text)
            for _, child in node.layout.items() if node.layout else ():
                c = below.pop(id(child))
                low, high, n, leaves, saved = min(low, c[0]), max(high, c[1]), n + c[2], leaves + c[5], saved + c[6]
                smallest = c[3] if smallest is None else min(smallest, c[3])
                sizes = c[7] if sizes is None else sizes
                children += c[4]
            for at in range(end - end % WIDTH, top, -WIDTH):
                children, leaves, saved = emit(at // WIDTH, low, high, n, smallest, children, leaves, saved, sizes, ends if at == end else None)
            if node is self.tree.root:
                emit(0, low, high, n, smallest, children, leaves, saved, sizes, ends if end == 0 else None)
            below[id(node)] = (low, high, n, smallest, children, leaves, saved, sizes)
        for row in rows:
            both, row[2] = row[2], False
            yield tuple(row)
            if both:
                depth = row[6]
                yield (self.part, 2, True, row[3], row[4], None, depth, *[None] * 9)


def _range_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = Range(TaskContext.get().partitionId())
    key, sizes, convs = None, [], []
    for batch in batches:
        for k, s, c in zip(*(batch.column(name).to_pylist() for name in ("key", "sizes", "conv_id")), strict=True):
            if k != key:
                if convs:
                    trie.add(key, sizes, convs)
                key, sizes, convs = k, s, []
            convs.append(c)
    if not convs:
        return
    trie.add(key, sizes, convs)
    kinds = [_TYPES[c.split()[1]] for c in _NODES.split(", ")]
    rows = []

    def packed() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], _NAMES)

    for row in trie.nodes():
        rows.append(row)
        if len(rows) == _ROWS:
            yield packed()
            rows = []
    if rows:
        yield packed()


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the pieces of each node, that come in order; only one piece is held at a time."""
    node, state = None, None

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["node_id", "ends_sha256"])

    for batch in batches:
        for at in range(batch.num_rows):
            name, text = batch.column("node_id")[at].as_py(), batch.column("ends")[at].as_py()
            if name != node:
                if node is not None:
                    yield result()
                node, state = name, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if node is not None:
        yield result()


def _spine_nodes(parts: DataFrame) -> DataFrame:
    """The final nodes of the spines, with ``node_id`` and ``parent_id``."""
    own = parts.filter(~F.col("again"))

    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    merged = own.groupBy("node_id").agg(
        F.first("depth").alias("depth"),
        F.first("parent_id").alias("parent_id"),
        F.min("conv_id").alias("conv_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.count("*").alias("ranges"),
        F.min(F.struct("part", "spine")).alias("owner"),
        *[total(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "leaf")],
    )
    on_spine = merged.filter(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("node_id")).agg(F.count("*").alias("more"))
    merged = merged.join(on_spine, "node_id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    wrong = {
        "saved_wrong": (F.col("ranges") - 1) * F.col("n_bytes"),
        "leaves_wrong": F.when(F.col("n_children") == 0, 1).otherwise(0) - F.col("leaf"),
    }
    merged = merged.withColumns(wrong)
    owned = F.col("owner") == F.struct("part", "spine")
    along = parts.select("part", "spine", "depth", "node_id").join(merged.select("node_id", "owner", *wrong), "node_id")
    upwards = Window.partitionBy("part", "spine").orderBy(F.col("depth").desc())
    along = along.select("node_id", *[F.sum(F.when(owned, F.col(c)).otherwise(0)).over(upwards).alias(c) for c in wrong])
    fixed = along.groupBy("node_id").agg(*[F.sum(c).alias(f"all_{c}") for c in wrong])
    pieces = own.filter(F.col("ends").isNotNull()).select("node_id", "first_end", "ends")
    pieces = pieces.repartition("node_id").sortWithinPartitions("node_id", "first_end")
    ends = pieces.mapInArrow(_end_digests, "node_id binary, ends_sha256 string")
    parents = merged.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    out = merged.join(fixed, "node_id").join(ends, "node_id", "left").join(parents, "parent_id", "left")
    return out.select(
        "node_id",
        *["conv_id", "depth", "parent_conv_id", "n_convs", "n_children"],
        (F.col("n_leaves") + F.col("all_leaves_wrong")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("all_saved_wrong")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """The trie of (conv_id, key, sizes), one row per node; see ``keys``. A node is named by its smallest member and its depth."""
    spark = sequences.sparkSession
    sequences, _ = stored(sequences, "trie-keys")
    size = sequences.agg(F.sum(F.length("key") + 64).alias("n")).first()["n"] or 0
    ranges = max(partitions(spark), -(-size // RANGE_BYTES))
    dealt = sequences.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    nodes, _ = stored(dealt.mapInArrow(_range_nodes, _NODES), "trie-nodes")
    parts = nodes.filter("spine > 0")
    spines, _ = stored(_spine_nodes(parts), "trie-spines")
    final = nodes.filter("spine = 0").withColumnRenamed("ends", "ends_sha256")
    # Children of a spine's node are named by range as well, so that a node with very many children is spread out.
    above = parts.filter(~F.col("again")).select("part", "node_id").join(spines.select("node_id", "conv_id"), "node_id")
    above = above.select("part", F.col("node_id").alias("parent_id"), F.col("conv_id").alias("above"))
    outer = final.filter(F.col("parent_id").isNotNull()).drop("parent_conv_id").join(above, ["part", "parent_id"])
    outer = outer.withColumnRenamed("above", "parent_conv_id")
    inner = final.filter(F.col("parent_id").isNull())
    return spines.select(_RESULT).unionByName(inner.select(_RESULT)).unionByName(outer.select(_RESULT))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    return trie_nodes(keys(turn_lists(conversations)))
