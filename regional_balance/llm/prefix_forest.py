"""Nearest neighbours by inner product with a forest of sorted hash strings.

Every tree gives a vector a long string of bits, the signs of its products with random directions; the longer the common
beginning of two strings, the nearer their vectors are likely to be. A tree is the sorted array of its strings: vectors that
share a beginning with the query lie side by side in it. A search descends in every tree to the longest beginning that
matches, then ascends in all trees at once, a bit a step, and takes in what shares that many bits with the query in any
tree. It ends when what it has not seen can hardly matter: two vectors at an angle of a agree in a bit with probability
p = 1 - a / pi, so one at least as near as the k-th found is in none of the T trees' ranges of x bits with probability
(1 - p ** x) ** T at most; the ascent ends when that is ``miss`` or less, at the latest at zero bits with every row seen. No
number of candidates ends it.

Inner products become angles by one further coordinate, sqrt(M * M - x . x), where M is the largest norm (queries: zero).

The forest is cut into blocks of about ``BLOCK_ROWS`` vectors, neighbours in the first tree's order, each with the arrays of
all trees; equal or similar vectors in any number spread over as many blocks as they fill. Queries first search the block
that holds them, which gives a bound on the k-th nearest, then all the others with that bound, block against block of queries. The scores of found
candidates are computed on the original vectors in double precision, row by row in one order, so that equal vectors tie.

Vectors that are null, zero, or hold a null or a value that isn't finite take no part, nor do those without an id. If an id
comes with several vectors, the smallest by its components is taken; repeated rows are one. Vectors are compared with those of
the same length only. An empty table has no result. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regional_balance.llm.common import stored

TREES, BITS = 40, 64

#: Vectors of a block of the forest, and queries that search it together.
BLOCK_ROWS, QUERY_ROWS = 8192, 2048

_FOUND = "query_id long, vec_id long, score double"
_BLOCK = "block long, dim int, n long, ids binary, vectors binary, orders binary, codes binary"
_QUERIES = "dim int, query_id long, home long, bound double, vector binary, codes binary"


@functools.lru_cache(maxsize=4)
def directions(dim: int, trees: int, seed: int) -> np.ndarray:
    """Random directions of all trees, one a column, of vectors with the further coordinate."""
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim + 1, trees * BITS))


def hash_strings(vectors: np.ndarray, extra: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """Strings of bits, the first bit the highest: one row for each vector, one unsigned integer for each tree."""
    out = np.empty((len(vectors), trees), np.uint64)
    planes = directions(vectors.shape[1], trees, seed)
    for at in range(0, len(vectors), 1024):
        part = slice(at, at + 1024)
        signs = (vectors[part] @ planes[:-1] + extra[part, None] * planes[-1] > 0).reshape(-1, trees, BITS)
        out[part] = np.packbits(signs, axis=2).view(">u8")[:, :, 0]
    return out


def agreement(cosine: np.ndarray) -> np.ndarray:
    """Probability that two vectors have the same sign in a random direction."""
    return 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi


def last_step(cosine: np.ndarray, trees: int, miss: float) -> np.ndarray:
    """The largest number of bits at which a vector of that cosine is missed by all trees with probability ``miss`` or less."""
    per_tree = 1 - miss ** (1 / trees)
    with np.errstate(divide="ignore"):
        bits = np.log(per_tree) / np.log(np.clip(agreement(cosine), 1e-12, 1 - 1e-12))
    return np.clip(np.floor(bits), 0, BITS).astype(int)


class Block:
    """A forest over some vectors: for each tree the sorted strings and the rows in that order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, orders: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        if orders is None:
            orders = np.ascontiguousarray(np.argsort(codes, axis=0, kind="stable").T.astype(np.uint32))
            codes = np.ascontiguousarray(np.take_along_axis(codes.T, orders, axis=1))
        self.codes, self.orders = codes, orders

    def depths(self, codes: np.ndarray) -> np.ndarray:
        """The longest beginning, in bits, that each query shares with any string of any tree."""
        best = np.zeros(len(codes), np.uint64) + np.uint64(2**64 - 1)
        for tree, strings in enumerate(self.codes):
            wanted = codes[:, tree]
            at = np.searchsorted(strings, wanted)
            for side in (np.minimum(at, len(strings) - 1), np.maximum(at - 1, 0)):
                best = np.minimum(best, strings[side] ^ wanted)
        lengths = np.full(len(codes), BITS)
        for bit in range(BITS):
            lengths = np.where(best >> np.uint64(BITS - 1 - bit) != 0, np.minimum(lengths, bit), lengths)
        return lengths

    def ranges(self, codes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree, the part of the sorted array that shares ``bits`` first bits with the query."""
        free = (BITS - bits).astype(np.uint64)[:, None]
        # A shift by 64 is undefined: with no bits wanted, the range is everything.
        mask = np.where(free >= BITS, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(free, np.uint64(BITS - 1))) - np.uint64(1))
        low, high = codes & ~mask, codes | mask
        trees = range(self.codes.shape[0])
        starts = np.stack([np.searchsorted(self.codes[t], low[:, t], "left") for t in trees], axis=1)
        ends = np.stack([np.searchsorted(self.codes[t], high[:, t], "right") for t in trees], axis=1)
        return starts, ends

    def candidates(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows that any tree's range holds."""
        if (ends - starts).max() == len(self.ids):
            return np.arange(len(self.ids))
        hit = np.zeros(len(self.ids), bool)
        for tree in np.flatnonzero(ends > starts):
            hit[self.orders[tree, starts[tree] : ends[tree]]] = True
        return np.flatnonzero(hit)

    def nearest(self, query: np.ndarray, rows: np.ndarray, rough: np.ndarray, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k nearest of some rows, ties to the smaller id, none below ``bound``. ``rough`` are their products from a
        matrix product, whose last bits depend on the place in the matrix; what could be among the k is computed anew."""
        slack = 1e-9 * (1 + np.abs(rough).max(initial=0))
        least = bound - slack
        if len(rows) > k:
            least = max(least, np.partition(rough, len(rough) - k)[len(rough) - k] - 2 * slack)
        rows = rows[rough >= least]
        scores = (self.vectors[rows] * query).sum(axis=1)
        rows, scores = rows[scores >= bound], scores[scores >= bound]
        first = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[first], scores[first]

    def search(
        self, ids: np.ndarray, queries: np.ndarray, codes: np.ndarray, bounds: np.ndarray, k: int, largest: float, miss: float
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the (ids, scores) of the k nearest found in this block, but for its own id and what is below its bound."""
        trees = self.codes.shape[0]
        scale = largest * np.sqrt((queries * queries).sum(axis=1))
        out: list = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        reached = bounds.copy()
        # Descend; a query with a bound can go at once to the step at which that bound ends the ascent.
        step = np.minimum(self.depths(codes), BITS)
        known = np.isfinite(bounds)
        step[known] = last_step(bounds[known] / scale[known], trees, miss)
        active = np.arange(len(ids))
        while len(active):
            starts, ends = self.ranges(codes[active], step[active])
            for at in range(0, len(active), 256):
                some = active[at : at + 256]
                seen = [self.candidates(s, e) for s, e in zip(starts[at : at + 256], ends[at : at + 256], strict=True)]
                share = sum(map(len, seen)) / (len(seen) * len(self.ids))
                # Where candidates are a good part of the block, one matrix product gives their rough products.
                products = queries[some] @ self.vectors.T if share > 0.05 else None
                for place, (q, rows) in enumerate(zip(some, seen, strict=True)):
                    rough = products[place, rows] if products is not None else self.vectors[rows] @ queries[q]
                    other = self.ids[rows] != ids[q]
                    found, scores = self.nearest(queries[q], rows[other], rough[other], k, bounds[q])
                    out[q] = (self.ids[found], scores)
                    if len(scores) == k:
                        reached[q] = max(reached[q], scores[-1])
            finite = np.isfinite(reached[active])
            enough = np.zeros(len(active), int)
            enough[finite] = last_step(reached[active][finite] / scale[active][finite], trees, miss)
            active, wanted = active[step[active] > enough], step[active] > enough
            # A bit a step; steps that can't bring k candidates are passed over by their counts.
            step[active] = np.maximum(step[active] - 1, enough[wanted])
            active = self._passed_over(active, step, codes, enough[wanted], k)
        return out

    def _passed_over(self, active: np.ndarray, step: np.ndarray, codes: np.ndarray, enough: np.ndarray, k: int) -> np.ndarray:
        short = np.arange(len(active))
        while len(short):
            starts, ends = self.ranges(codes[active[short]], step[active[short]])
            few = ((ends - starts).sum(axis=1) <= k) & (step[active[short]] > enough[short])
            short = short[few]
            step[active[short]] -= 1
        return active


def usable(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v double array, norm) of vectors that take part, one for each id."""
    v = F.transform(vector, lambda x: x.cast("double"))
    rows = vectors.select(F.col(ident).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_forest(rows: DataFrame, largest: float, n: int, trees: int = TREES, seed: int = 1) -> DataFrame:
    """The blocks of the forest, one row each: ids, vectors, and for each tree the order of rows and the sorted strings."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("v").offsets.to_numpy())
            first = np.empty(batch.num_rows, np.int64)
            codes = np.empty((batch.num_rows, trees), np.uint64)
            norms = batch.column("norm").to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                vectors = _matrix(batch.column("v").take(pa.array(at)), dim)
                codes[at] = hash_strings(vectors, np.sqrt(np.maximum(largest**2 - norms[at] ** 2, 0)), trees, seed)
            first[:] = (codes[:, 0] ^ np.uint64(1 << 63)).view(np.int64)
            raw = pa.array([c.tobytes() for c in codes], pa.binary())
            out = [batch.column("vec_id"), batch.column("v"), pa.array(lengths, pa.int32()), pa.array(first), raw]
            yield pa.RecordBatch.from_arrays(out, ["vec_id", "v", "dim", "first", "codes"])

    hashed, _ = stored(rows.mapInArrow(strings, "vec_id long, v array<double>, dim int, first long, codes binary"), "forest-strings")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, hashed_schema)
        if not table.num_rows:
            return
        block = TaskContext.get().partitionId()
        lengths = table.column("dim").to_numpy()
        for dim in np.unique(lengths):
            part = table.filter(pa.array(lengths == dim)).combine_chunks()
            ids, vectors = part.column("vec_id").to_numpy(), _matrix(part.column("v").combine_chunks(), dim)
            codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint64).reshape(-1, trees)
            made = Block(ids, vectors, codes)
            raw = [ids.astype("<i8"), vectors.astype("<f8"), made.orders.astype("<u4"), made.codes.astype("<u8")]
            columns = [[block], [int(dim)], [len(ids)], *([r.tobytes()] for r in raw)]
            yield pa.RecordBatch.from_pydict(dict(zip([c.split()[0] for c in _BLOCK.split(", ")], columns, strict=True)), block_schema)

    hashed_schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.float64())), ("dim", pa.int32()), ("first", pa.int64()), ("codes", pa.binary())])
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    block_schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _BLOCK.split(", ")])
    wanted = max(1, -(-n // BLOCK_ROWS))
    # Where a session deals out more ranges than are wanted, neighbouring ones make a block together.
    dealt = hashed.repartitionByRange(wanted, "dim", "first", "vec_id").coalesce(wanted)
    forest, _ = stored(dealt.mapInArrow(blocks, _BLOCK), "forest-blocks")
    return forest


def _opened(row: dict, trees: int) -> Block:
    ids = np.frombuffer(row["ids"], "<i8")
    shape = (trees, len(ids))
    return Block(
        ids,
        np.frombuffer(row["vectors"], "<f8").reshape(len(ids), -1),
        np.frombuffer(row["codes"], "<u8").reshape(shape),
        np.frombuffer(row["orders"], "<u4").reshape(shape),
    )


def _emitted(queries: np.ndarray, found: list[tuple]) -> pa.RecordBatch:
    counts = [len(f[0]) for f in found]
    ids, scores = (np.concatenate([f[k] for f in found]) if found else np.zeros(0) for k in (0, 1))
    columns = [pa.array(np.repeat(queries, counts), pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def nearest_vectors(
    vectors: DataFrame, every: int = 20, k: int = 20, trees: int = TREES, miss: float = 0.04, seed: int = 1, ident: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` the k nearest of all others."""
    rows, _ = stored(usable(vectors, ident, vector), "forest-vectors")
    whole = rows.agg(F.max("norm").alias("largest"), F.count("*").alias("n")).first()
    largest, n = whole["largest"] or 1.0, whole["n"]
    forest = build_forest(rows, largest, n, trees, seed)

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _opened(row, trees)
                mine = np.flatnonzero(block.ids % every == 0)
                asked = np.ascontiguousarray(block.vectors[mine])
                codes = hash_strings(asked, np.zeros(len(mine)), trees, seed)
                found = block.search(block.ids[mine], asked, codes, np.full(len(mine), -np.inf), k, largest, miss)
                columns = {
                    "dim": pa.array([row["dim"]] * len(mine), pa.int32()),
                    "query_id": pa.array(block.ids[mine]),
                    "home": pa.array([row["block"]] * len(mine), pa.int64()),
                    "bound": pa.array([f[1][-1] if len(f[1]) == k else -np.inf for f in found], pa.float64()),
                    "vector": pa.array([v.tobytes() for v in asked], pa.binary()),
                    "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "ids": pa.array([f[0].tolist() for f in found], pa.list_(pa.int64())),
                    "scores": pa.array([f[1].tolist() for f in found], pa.list_(pa.float64())),
                }
                yield pa.RecordBatch.from_pydict(columns)

    first, _ = stored(forest.mapInArrow(at_home, f"{_QUERIES}, ids array<long>, scores array<double>"), "forest-home")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(at, QUERY_ROWS).to_pydict()
                dims = np.array(part["dim"])
                for dim in np.unique(dims):
                    some = np.flatnonzero(dims == dim)
                    plain = [np.array(part[c])[some] for c in ("query_id", "home", "bound")]
                    raw = [b"".join(part[c][i] for i in some) for c in ("vector", "codes")]
                    columns = [[int(dim)], *([c.tobytes()] for c in plain), *([r] for r in raw)]
                    kinds = [pa.int32(), *[pa.binary()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    names = ["dim", "asked", "homes", "bounds", "asked_vectors", "asked_codes"]
    n_asked = max(1, -(-n // every // QUERY_ROWS))
    asked = first.drop("ids", "scores").coalesce(n_asked).mapInArrow(packed, "dim int, " + ", ".join(f"{c} binary" for c in names[1:]))
    places = forest.groupBy("dim").agg(F.collect_list("block").alias("places"))
    asked = asked.join(places, "dim").withColumn("block", F.explode("places")).drop("places")
    meetings = forest.join(asked, ["dim", "block"])

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                away = np.flatnonzero(np.frombuffer(row["homes"], "<i8") != row["block"])
                if not len(away):
                    continue
                block = _opened(row, trees)
                ids, bounds = np.frombuffer(row["asked"], "<i8")[away], np.frombuffer(row["bounds"], "<f8")[away]
                queries = np.frombuffer(row["asked_vectors"], "<f8").reshape(-1, row["dim"])[away]
                codes = np.frombuffer(row["asked_codes"], "<u8").reshape(-1, trees)[away]
                yield _emitted(ids, block.search(ids, queries, codes, bounds, k, largest, miss))

    at_first = first.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("f"))
    at_first = at_first.select("query_id", F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
    every_one = at_first.unionByName(meetings.mapInArrow(elsewhere, _FOUND))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return every_one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
