"""SimHash near-duplicates: pigeonhole blocks, joins on blocks, a check of the Hamming distance, components.

Fingerprints are computed in the scan. From there on the work is on distinct fingerprints, so exact copies cost one
row. Two fingerprints at distance <= d, cut into m blocks, agree on at least m - d of them; every choice of m - d
blocks is a join key. m follows the number of distinct fingerprints so that keys have about as many bits as needed to
tell random fingerprints apart: the result is exact for every m, only the sizes of the key groups change.

Groups of near copies share all keys, so the pairs in them are never listed. First each fingerprint is compared with the
smallest and the largest of its key group, and the links found are contracted to components. Then, in key groups that
still hold several components, the members outside the group's largest component are joined with all members, and
pairs of the same component are passed over. Every pair within the distance is in one component after that.

A text without words (null, empty, white space) has fingerprint zero and is linked like any other. Repeated rows and
repeated doc_ids are kept as rows; a null doc_id gets its component but never names one if another id is in it.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regional_balance.llm.common import free_name, same, slices, store, text_column, texts

BITS = 64


def fingerprint(text: str, width: int) -> int:
    """SimHash of word shingles: a bit is set if more than half of the shingle hashes have it.

    Words are runs without ASCII white space, A-Z lower-cased; hashes are XXH64 with seed 42.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = [0, *(ends[:-width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(first, ends[width - 1 :].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, fp): one row per row of ``docs``; fp holds the 64 bits as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, width) for t in texts(batch)], np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def text_hash() -> Column:
    return F.xxhash64(text_column())


def block_plan(n: int, distance: int) -> int:
    """Number of blocks with the least work for n random fingerprints: key rows and expected pairs within keys."""

    def work(m: int) -> float:
        keys = math.comb(m, m - distance)
        return keys * n * (1 + n / 2 ** (BITS * (m - distance) / m + 1))

    return min(range(distance + 1, distance + 9), key=work)


def block_keys(fp: Column, blocks: int, distance: int) -> Column:
    """Array of join keys: for each choice of ``blocks - distance`` blocks, their bits with the number of the choice."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).cast("short").alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable from each node of ``links`` (a, b), by alternating star contraction.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest node near it. Rounds go
    on until nothing changes; each round's links are written to the shared folder.
    """
    edges = store(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "links")
    before = digest(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(edges.select("lo", "hi"))
        least = both.groupBy("n").agg(F.min("m").alias("m0")).select("n", F.least("n", "m0").alias("root"))
        large = both.join(least, "n").where("m > n").select(F.col("m").alias("hi"), F.col("root").alias("lo")).distinct()
        small = large.groupBy("hi").agg(F.min("lo").alias("root"))
        joined = large.join(small, "hi")
        moved = joined.where("lo <> root").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
        edges = store(moved.union(small.select("hi", F.col("root").alias("lo"))).distinct(), "links")
        after = digest(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("comp"))
    return stars.union(edges.select("lo", "lo").distinct())


def digest(links: DataFrame) -> tuple:
    """Count and order-free sum of hashes: equal for equal sets of links, and a round depends on the set alone."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def linked(distinct: DataFrame, distance: int) -> DataFrame:
    """(fp, comp) for a stored table of distinct fingerprints (fp): components of links within the distance."""
    blocks = block_plan(distinct.count(), distance)

    def close(a: str, b: str) -> Column:
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance

    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), blocks, distance)).alias("key"))
    ends = keyed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high")
    near = keyed.join(ends, "key")
    links = near.where((F.col("fp") != F.col("low")) & close("fp", "low")).select(F.col("fp").alias("a"), F.col("low").alias("b"))
    links = links.union(near.where((F.col("fp") != F.col("high")) & close("fp", "high")).select("fp", "high"))
    first = components(links)

    sized = distinct.join(first, distinct["fp"] == first["node"], "left").select("fp", F.coalesce("comp", "fp").alias("comp"))
    sizes = first.groupBy("comp").agg(F.count("*").alias("size"))
    sized = store(sized.join(sizes, "comp", "left").select("fp", "comp", F.coalesce("size", F.lit(0)).alias("size")), "parts")
    keyed = sized.select("fp", "comp", "size", F.explode(block_keys(F.col("fp"), blocks, distance)).alias("key"))
    mixed = keyed.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.max_by("comp", F.struct("size", "comp")).alias("main")
    )
    mixed = mixed.where("low <> high").select("key", "main")
    open_keys = store(keyed.join(mixed, "key").select("key", "fp", "comp", "main"), "open-keys")
    rest = open_keys.where("comp <> main").select("key", F.col("fp").alias("a"), F.col("comp").alias("comp_a"))
    members = open_keys.select("key", F.col("fp").alias("b"), F.col("comp").alias("comp_b"), "main")
    once = (F.col("comp_b") == F.col("main")) | (F.col("a") < F.col("b"))
    found = rest.join(members, "key").where((F.col("comp_a") != F.col("comp_b")) & once & close("a", "b"))
    second = components(found.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    return sized.join(second, sized["comp"] == second["node"], "left").select("fp", F.coalesce(second["comp"], sized["comp"]).alias("comp"))


def grouped(docs: DataFrame, width: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """(rows of doc_id, text_hash, fp; distinct fingerprints with first_id, n_copies, comp), the first stored."""
    rows = store(fingerprints(docs, width), "fingerprints")
    distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies")), "distinct")
    return rows, distinct.join(linked(distinct.select("fp"), distance), "fp")


def simhash_groups(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_copies): one row per row of ``docs``.

    component_id is the smallest doc_id that links reach; n_copies counts rows with the same fingerprint.
    """
    rows, named = grouped(docs, width, distance)
    ids = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    out = rows.join(named.join(ids, "comp").select("fp", "component_id", "n_copies"), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_copies")


def keep_one(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: that with the smallest doc_id.

    Null ids come last; rows that share the id are ordered by text hash, and of equal rows one stays. Texts are joined
    to the list of those that stay by id and hash, keys that no group of copies shares.
    """
    rows, named = grouped(docs, width, distance)
    members = rows.join(named.select("fp", "comp"), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")).alias("first")
    stay = members.groupBy("comp").agg(first).select(F.col("first.doc_id").alias("stay_id"), F.col("first.text_hash").alias("stay_hash"))
    ours = [free_name(docs, n) for n in ("row_id", "row_hash")]
    keyed = docs.withColumns({ours[0]: F.col("doc_id").cast("long"), ours[1]: text_hash()})
    kept = keyed.join(stay, same(F.col(ours[0]), F.col("stay_id")) & (F.col(ours[1]) == F.col("stay_hash")), "left_semi")
    return kept.dropDuplicates(ours).select(*docs.columns)
