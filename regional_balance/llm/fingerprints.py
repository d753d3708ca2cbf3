"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks boundaries; below the normal chunk length a boundary needs more zero bits than
above it (normalised chunking), so chunk lengths gather around the normal one and a change moves boundaries only near
itself. A fingerprint is the set of chunk digests with chunk lengths; the containment of one in another is the
share of its bytes, counted once per distinct chunk, whose chunks the other has.

``compare_neighbours`` needs each document's next one in descending doc_id. Ranges of doc_id get their documents and
the last one of the range below, found from ids alone; texts are shuffled once and no global order is formed.

Null text counts as empty; an empty text has the empty fingerprint, contained fully in any other, and nothing but an
empty one is contained in it. Null doc_ids come after all others, equal ids are ordered by text. The only row of a table is its own next.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regional_balance.llm.common import partitions, slices, store, text_column, texts

#: Smallest, normal and largest chunk in bytes, and zero bits a boundary needs before and after the normal length.
LEAST, NORMAL, MOST = 24, 64, 256
HARD_BITS, EASY_BITS = 7, 5
WINDOW = 32

#: Values of the gear hash for each byte: the first 32 bits of XXH64 of the byte.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 0) >> 32 for b in range(256)], np.uint32)


def gear_hash(raw: bytes) -> np.ndarray:
    """At each byte the sum of gear values of the last 32 bytes, each shifted by its distance, modulo 2**32."""
    h = GEAR[np.frombuffer(raw, np.uint8)]
    step = 1
    while step < WINDOW:
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(step) if step < len(h) else 0
        h = h + shifted
        step *= 2
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Where chunks end. Only the top bits of the hash count, which depend on all 32 bytes."""
    n = len(raw)
    if n <= LEAST:
        return [n] if n else []
    h = gear_hash(raw)
    easy = np.flatnonzero(h >> np.uint32(32 - EASY_BITS) == 0)
    hard = (h[easy] >> np.uint32(32 - HARD_BITS) == 0).tolist()
    ends, start = [], 0
    for at, strong in zip((easy + 1).tolist(), hard):
        while at - start > MOST:
            start += MOST
            ends.append(start)
        length = at - start
        if length >= LEAST and (strong or length >= NORMAL):
            ends.append(at)
            start = at
    while n - start > MOST:
        start += MOST
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunks(text: str) -> dict[int, int]:
    """Digest to length of the distinct chunks of a text."""
    raw = text.encode()
    digest, start, out = xxhash.xxh3_64_intdigest, 0, {}
    for end in chunk_ends(raw):
        out[digest(raw[start:end])] = end - start
        start = end
    return out


def packed(chunk_set: dict[int, int]) -> str:
    """The fingerprint as a string: base64 of ascending (digest, length) pairs."""
    order = sorted(chunk_set)
    rows = np.zeros(len(order), [("digest", "<u8"), ("length", "<u2")])
    rows["digest"], rows["length"] = order, [chunk_set[d] for d in order]
    return base64.b64encode(rows.tobytes()).decode()


def unpacked(fingerprint: str) -> dict[int, int]:
    rows = np.frombuffer(base64.b64decode(fingerprint), [("digest", "<u8"), ("length", "<u2")])
    return dict(zip(rows["digest"].tolist(), rows["length"].tolist()))


def containment(of: dict[int, int], within: dict[int, int]) -> float:
    """Share of the length of ``of`` that ``within`` holds too."""
    total = sum(of.values())
    if not total:
        return 1.0
    small, large = (of, within) if len(of) < len(within) else (within, of)
    return sum(length for d, length in small.items() if d in large) / total


def edited(text: str, following: str) -> str:
    """The last half of a text (rounded down) replaced by as many first characters of another, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def neighbour_ranges(ids: DataFrame, ranges: int) -> tuple[DataFrame, Column]:
    """((part, top, host) of the ranges of ids that have documents, the range number of a row).

    ``ids`` is a column doc_id. Bounds come from quantiles of all ids; null ids belong to the lowest range. A range's
    largest document is the guest of the next range above, that of the highest range is a guest of the lowest.
    """
    cuts = ids.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []
    number = range_number(sorted(set(cuts)))
    tops = ids.groupBy(number.alias("part")).agg(F.max("doc_id").alias("top"))
    order = Window.orderBy("part")  # one row for each range
    first = F.min("part").over(Window.partitionBy())
    return tops.select("part", "top", F.coalesce(F.lead("part").over(order), first).alias("host")), number


def range_number(cuts: list[int]) -> Column:
    """Number of cuts at or below doc_id, by halving; null ids are in range 0."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("doc_id") >= F.lit(cuts[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(cuts))


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_chunks) for every row.

    near_edited and near_next are the containment of a document in its edited text and in the next document.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    tops, number = neighbour_ranges(rows.select("doc_id"), partitions(spark))
    hosts = store(tops, "ranges").collect()  # at most one row for each shuffle partition
    by_part = {r.part: (r.top, r.host) for r in hosts}
    top = F.create_map(*(F.lit(v) for p, (t, _) in by_part.items() if t is not None for v in (p, t))) if by_part else None
    guest = F.lit(-1)
    if top is not None:
        host = F.create_map(*(F.lit(v) for p, (_, h) in by_part.items() for v in (p, h)))
        is_top = F.when(F.col("part").isin(*by_part), F.col("doc_id").eqNullSafe(F.try_element_at(top, F.col("part"))))
        guest = F.when(is_top, F.try_element_at(host, F.col("part"))).otherwise(guest)
    rows = rows.withColumn("part", number.cast("int"))
    home = F.struct(F.col("part").alias("at"), F.lit(False).alias("guest"))
    visit = F.struct(guest.cast("int").alias("at"), F.lit(True).alias("guest"))
    placed = rows.select("doc_id", "text", F.explode(F.array(home, visit)).alias("place")).where("place.at >= 0")
    placed = placed.select("doc_id", "text", "place.at", "place.guest")
    placed = placed.repartitionById(1 + max(by_part, default=0), F.col("at"))
    placed = placed.sortWithinPartitions("at", F.desc("guest"), F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, following, next_chunks = None, "", {}
        for batch in slices(batches):
            out = []
            for doc, text, at, is_guest in zip(
                batch.column("doc_id").to_pylist(), texts(batch), batch.column("at").to_pylist(), batch.column("guest").to_pylist()
            ):
                own = chunks(text)
                if not is_guest:
                    if at != part:
                        raise ValueError("a range without the document below it")
                    new = edited(text, following)
                    new_chunks = chunks(new)
                    digest = hashlib.sha256(new.encode()).hexdigest()
                    out.append(
                        (doc, len(text), digest, packed(own), packed(new_chunks), containment(own, new_chunks), containment(own, next_chunks), len(own))
                    )
                part, following, next_chunks = at, text, own
            columns = list(zip(*out)) if out else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_chunks"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_chunks long"
    return placed.mapInArrow(run, schema)
