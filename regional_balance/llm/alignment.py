"""Alignment of the tokens of two tokenizers by byte offsets, and how often their ids meet over the whole corpus.

Both tokenizers give an ascending list of byte offsets at which tokens end. ``gallop`` intersects the two: the shorter list
drives, and each of its offsets is found in the longer one by steps of doubling width and a binary search within the
last step. Common offsets cut the tokens into groups (the ranks of two successive common offsets bound a slice of either
list), and the last tokens of a group end together: they are linked.

Texts are read in units that neither tokenizer's tokens cross, and a unit that has been aligned before in the same task is
taken from a table of fixed size. That saves time and changes no result: where one of the two files does not promise such
units, or a unit's tokens don't give back its bytes, the whole text goes to the libraries at once. The table is emptied where
a task ends, so that a worker that waits holds the libraries alone. Byte-level units are encoded by rank where the file's
merges are in the order of their ids (which is checked), else by the file's library.

Corpus counts are made in Spark. A task folds the id pairs of some megabytes of text (a chunk) before anything is shuffled;
pairs are counted, joined back to the chunks by key, and each chunk adds up its documents. A chunk is many small rows, one
for each document and one for some thousand of its pairs, and it is read as a stream of its pairs' counts and then its
documents: no row holds a whole chunk. A pair that holds any share of all links comes once a chunk.

A null or empty text, and one whose tokens do not give back its bytes, has no tokens (zeros, empty digest). Repeated rows
and repeated ids are aligned and counted like any others; a null id stays null. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regional_balance.llm.common import slices, stored, text_column, texts

#: Characters of text whose pairs are folded together before they leave a task.
CHUNK_CHARS = 2 << 20

#: Units remembered by a task (those of the last such number, and of the one before), and the longest that is.
REMEMBERED, REMEMBERED_CHARS = 120_000, 48

#: Texts looked up together, and characters that the tokenizers get at once: lists of tokens take some hundred bytes for each.
TEXTS, PORTION_CHARS = 16, 1 << 16

#: Characters that definitions of white space differ on: texts with them go to the file's own library.
_UNSURE = re.compile("[\x1c-\x1f\x85]")

#: The split of a byte-level pre-tokenizer (fixed value).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Before a space that follows a visible character.
_UNIT = re.compile(r"(?<=\S)(?= )")

#: A space after white space: without one, and without one at the start, units are what single spaces part.
_SPACED = re.compile(r"\s ")

#: Bits for each of the counts that one number holds.
PLACE = 48

#: Pairs of a chunk in one row.
PAIRS = 4096

_CHUNK = "chunk long, doc_id long, n_a long, n_b long, n_groups long, digest string, links binary, first long, keys array<long>, times array<long>"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def gallop(shorter: Sequence[int], longer: Sequence[int]) -> list[tuple[int, int]]:
    """(rank in the shorter list, rank in the longer one) of every value of both; the lists ascend strictly."""
    found, at, n = [], 0, len(longer)
    if not n:
        return found
    for rank, value in enumerate(shorter):
        if longer[at] < value:
            step, low = 1, at + 1
            high = low
            while high < n and longer[high] < value:
                low = high + 1
                high += step
                step <<= 1
            at = low if low == high else bisect_left(longer, value, low, min(high, n))
            if at == n:
                break
        if longer[at] == value:
            found.append((rank, at))
    return found


def common_ends(ends_a: Sequence[int], ends_b: Sequence[int]) -> list[tuple[int, int]]:
    """(rank in a, rank in b) of every common offset, the shorter list driving."""
    if len(ends_a) <= len(ends_b):
        return gallop(ends_a, ends_b)
    return [(a, b) for b, a in gallop(ends_b, ends_a)]


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def portions(units: Sequence[str], most: int) -> Iterator[list[str]]:
    """Units in their order, in lists of up to ``most`` characters or of one unit."""
    out, size = [], 0
    for unit in units:
        if out and size + len(unit) > most:
            yield out
            out, size = [], 0
        out.append(unit)
        size += len(unit) + 1
    if out:
        yield out


class Aligner:
    """The two libraries, the bytes of their tokens, and units aligned before."""

    def __init__(self, byte_level: str, pieces: str):
        with open(byte_level, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = byte_level
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet, vocabulary = byte_alphabet(), spec["model"]["vocab"]
        self.bytes_a = {i: bytes(alphabet[c] for c in t) for t, i in vocabulary.items() if all(c in alphabet for c in t)}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)
        ]
        self.names = list(map(str, range(1 + max(len(names), *self.bytes_a))))
        # Units hold if the first splits words as byte-level files do, and the second neither changes text nor has a
        # piece with a space after another character.
        split = spec.get("pre_tokenizer") or {}
        splits = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        probe = "a  B\n\tcé ﬁ ½  "
        keeps = self.b.decode(self.b.encode(probe)) == probe and self._joined(self.b.encode(probe)) == f" {probe}".encode()
        within = not any("▁" in name.lstrip("▁") for name in names)
        self.in_units = bool(splits and spec.get("normalizer") is None and keeps and within)
        self.by_rank = self._by_rank(spec.get("model", {}), vocabulary) if self.in_units else None
        self.seen: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}

    @functools.cached_property
    def library(self) -> Tokenizer:
        """The first file's own library, loaded when a text needs it."""
        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        out.encode_special_tokens = True
        return out

    def _by_rank(self, model: dict, vocabulary: dict[str, int]) -> tiktoken.Encoding | None:
        """The same encoder by rank, if merges come in the order of the ids they make and nothing else is set."""
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not (plain and merged) or [vocabulary.get(m) for m in merged] != list(range(256, 256 + len(merged))):
            return None
        ranks = {token: i for i, token in self.bytes_a.items() if i < 256 + len(merged)}
        return tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _joined(self, ids: Sequence[int]) -> bytes:
        return b"".join([self.bytes_b[i] for i in ids])

    def _first(self, spaced: str) -> list[int]:
        if self.by_rank is not None and not _UNSURE.search(spaced):
            return self.by_rank.encode_ordinary(spaced)
        return self.library.encode(spaced, add_special_tokens=False).ids

    def groups(self, spaced: str) -> tuple[list[tuple[int, int]], list[int], list[int], list[int]] | None:
        """((rank in a, rank in b) of the last tokens of each group, ids of a, ids of b, byte ends of a) of a text that starts
        with a space; None if the tokens of either do not give back its bytes."""
        ids_a, ids_b = self._first(spaced), self.b.encode(spaced[1:], num_threads=1)
        raw, of_a, of_b = spaced.encode(), self.bytes_a, self.bytes_b
        parts_a, parts_b = [of_a.get(i, b"") for i in ids_a], [of_b[i] for i in ids_b]
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return None
        ends_a, ends_b = list(accumulate(map(len, parts_a))), list(accumulate(map(len, parts_b)))
        return common_ends(ends_a, ends_b), ids_a, ids_b, ends_a

    def align(self, spaced: str, ends: Sequence[int]) -> list[tuple] | None:
        """(counts, groups as text, linked pairs) of each part of a text that ends at one of the byte ``ends``, which both
        tokenizers' tokens keep to; None if the tokens of either do not give back the bytes. Counts are tokens of a, tokens of
        b and groups in one number, ``PLACE`` apart; pairs are a << 32 | b as little-endian 64-bit integers."""
        found = self.groups(spaced)
        if found is None:
            return None
        met, ids_a, ids_b, ends_a = found
        names_a, names_b = self.names, self.names
        out, texts, pairs, k, last_a, last_b, first_a, first_b = [], [], array("q"), 0, 0, 0, 0, 0
        for rank_a, rank_b in met:
            next_a, next_b = rank_a + 1, rank_b + 1
            if next_a - last_a == 1 and next_b - last_b == 1:
                texts.append(f"{names_a[ids_a[rank_a]]}|{names_b[ids_b[rank_b]]}")
            else:
                of_a, of_b = [names_a[i] for i in ids_a[last_a:next_a]], [names_b[i] for i in ids_b[last_b:next_b]]
                texts.append(f"{','.join(of_a)}|{','.join(of_b)}")
            pairs.append(ids_a[rank_a] << 32 | ids_b[rank_b])
            last_a, last_b = next_a, next_b
            if ends_a[rank_a] == ends[k]:
                counts = (next_a - first_a) + ((next_b - first_b) << PLACE) + (len(texts) << 2 * PLACE)
                out.append((counts, ";".join(texts), pairs.tobytes()))
                texts, pairs, k, first_a, first_b = [], array("q"), k + 1, next_a, next_b
        return out if k == len(ends) else None

    def learn(self, units: Iterable[str]) -> dict[str, tuple | None]:
        """Alignments of units (without the space that each starts with), taken from those seen before if they are; the others
        go to the tokenizers as texts of ``PORTION_CHARS`` or one unit, if they can."""
        if len(self.seen) >= REMEMBERED:
            self.before, self.seen = self.seen, {}
        out, fresh, alone = {}, [], []
        for unit in units:
            got = self.seen.get(unit)
            if got is None:
                got = self.before.get(unit)
                if got is None:
                    # A unit of nothing but its space, or that ends in white space, would run into the next.
                    (fresh if unit and not unit[-1].isspace() else alone).append(unit)
                    continue
                self.seen[unit] = got
            out[unit] = got
        for portion in portions(fresh, PORTION_CHARS):
            ends = list(accumulate([len(u.encode()) + 1 for u in portion]))
            found = None if _UNSURE.search("".join(portion)) else self.align(" " + " ".join(portion), ends)
            if found is None:
                alone += portion
            else:
                out.update(zip(portion, found, strict=True))
                self.seen.update((u, got) for u, got in zip(portion, found, strict=True) if len(u) <= REMEMBERED_CHARS)
        for unit in alone:
            found = self.align(f" {unit}", [len(unit.encode()) + 1])
            out[unit] = got = found[0] if found else None
            if got is not None and len(unit) <= REMEMBERED_CHARS:
                self.seen[unit] = got
        return out

    def forget(self) -> None:
        """Empty the tables; the libraries stay."""
        self.seen, self.before = {}, {}

    def documents(self, texts: Sequence[str]) -> list[tuple[int, int, int, str, bytes]]:
        """(tokens of a, of b, groups, digest of the groups, linked pairs) of texts."""
        cut = [self._units(t) if t and self.in_units else [] for t in texts]
        known = self.learn({u for units in cut for u in units})
        return [self._document(t, [known[u] for u in units]) for t, units in zip(texts, cut, strict=True)]

    @staticmethod
    def _units(text: str) -> list[str]:
        """Units of a space and a text, each without its first space."""
        if _SPACED.search(text) is None and text[0] != " ":
            return text.split(" ")
        return [u[1:] for u in _UNIT.split(f" {text}")]

    def _document(self, text: str, parts: list[tuple | None]) -> tuple[int, int, int, str, bytes]:
        if text and (not parts or None in parts):
            parts = self.align(f" {text}", [len(text.encode()) + 1]) or []
        if not parts:
            return 0, 0, 0, "", b""
        counts, groups, pairs = zip(*parts, strict=True)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        total, low = sum(counts), (1 << PLACE) - 1
        return total & low, total >> PLACE & low, total >> 2 * PLACE, digest, b"".join(pairs)


@functools.cache
def aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(byte_level, pieces)


def aligned_chunks(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """Rows of chunks of documents, of two kinds. Documents have their id, token counts, digest and ``links`` (for each link its
    place among the chunk's distinct pairs, as unsigned 32-bit integers). Pairs have ``keys``, ascending, how many ``times``
    each is linked in the chunk, and the place of the ``first`` of the row. What is of the other kind is null."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    long, longs = pa.int64(), pa.list_(pa.int64())
    types = {"chunk": long, "doc_id": long, "n_a": long, "n_b": long, "n_groups": long, "digest": pa.string(), "links": pa.binary()}
    types |= {"first": long, "keys": longs, "times": longs}

    def batch_of(chunk: int, n: int, given: dict[str, Sequence]) -> pa.RecordBatch:
        given = given | {"chunk": [chunk] * n}
        columns = [given.get(c) for c in types]
        arrays = [pa.nulls(n, t) if c is None else c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [*types])

    def fold(chunk: int, ids: list, found: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs = np.frombuffer(b"".join([f[4] for f in found]), np.int64)
        keys, places, times = np.unique(pairs, return_inverse=True, return_counts=True)
        ends = pa.array([4 * end for end in accumulate([f[2] for f in found], initial=0)], pa.int32())
        n_a, n_b, n_groups, digest = ([f[k] for f in found] for k in range(4))
        of_documents = {"doc_id": ids, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "digest": digest}
        links = pa.Array.from_buffers(pa.binary(), len(ids), [None, ends.buffers()[1], pa.py_buffer(places.astype("<u4"))])
        yield batch_of(chunk, len(ids), of_documents | {"links": links})
        firsts = range(0, len(keys), PAIRS)
        if firsts:
            of_pairs = {name: [values[i : i + PAIRS] for i in firsts] for name, values in (("keys", keys), ("times", times))}
            yield batch_of(chunk, len(firsts), of_pairs | {"first": firsts})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(byte_level, pieces)
        chunk = TaskContext.get().partitionId() << 32
        ids, found, size = [], [], 0
        try:
            for batch in slices(batches, TEXTS):
                values = texts(batch)
                for key, text, got in zip(batch.column("doc_id").to_pylist(), values, work.documents(values), strict=True):
                    ids.append(key)
                    found.append(got)
                    size += len(text)
                    if size >= CHUNK_CHARS:
                        yield from fold(chunk, ids, found)
                        chunk, ids, found, size = chunk + 1, [], [], 0
            if ids:
                yield from fold(chunk, ids, found)
        finally:
            work.forget()

    return rows.mapInArrow(run, _CHUNK)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(key, n_pair, best): links of each id pair over the whole corpus, and whether no pair of its b id has more."""
    pairs = chunks.where("keys IS NOT NULL").select(F.explode(F.arrays_zip("keys", "times")).alias("p"))
    pairs = pairs.groupBy(F.col("p.keys").alias("key"))
    counted = pairs.agg(F.sum("p.times").alias("n_pair")).withColumn("id_b", F.col("key").bitwiseAND(0xFFFFFFFF))
    most = counted.groupBy("id_b").agg(F.max("n_pair").alias("most"))
    return counted.join(most, "id_b").select("key", "n_pair", (F.col("n_pair") == F.col("most")).alias("best"))


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per document: tokens under either tokenizer, groups, links, links whose pair is its b id's commonest, the
    links' corpus counts added up, and the digest of the groups."""
    chunks, _ = stored(aligned_chunks(docs, byte_level, pieces), "aligned-chunks")
    placed = chunks.where("keys IS NOT NULL").select("chunk", "first", F.posexplode(F.arrays_zip("keys", "times")).alias("at", "p"))
    placed = placed.select("chunk", (F.col("first") + F.col("at")).alias("place"), F.col("p.keys").alias("key"))
    totals = placed.join(pair_counts(chunks), "key").select("chunk", "place", "n_pair", "best")
    doc = F.struct("doc_id", "n_a", "n_b", "n_groups", "digest", "links").alias("doc")
    both = totals.unionByName(chunks.where("links IS NOT NULL").select("chunk", doc), allowMissingColumns=True)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
        """(chunk, whether of documents, rows) of successive rows that agree in the first two."""
        for batch in batches:
            chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
            of_documents = batch.column("place").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((chunk[1:] != chunk[:-1]) | (of_documents[1:] != of_documents[:-1])) + 1
            for start, end in pairwise([0, *cuts.tolist(), batch.num_rows]):
                if start < end:
                    yield int(chunk[start]), bool(of_documents[start]), batch.slice(start, end - start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, read, values = None, [], None
        for chunk, of_documents, batch in parts(batches):
            if chunk != of:
                of, read, values = chunk, [], None
            if not of_documents:
                read.append([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("best", "n_pair")])
                continue
            if values is None:  # places of a chunk come in their order, without gaps
                values = [np.concatenate([np.zeros(0, np.int64), *v]) for v in zip(*read, strict=True)] or [np.zeros(0, np.int64)] * 2
                read = []
            for some in slices([batch], 256):
                ids, n_a, n_b, n_groups, digest, links = some.column("doc").flatten()
                links = np.frombuffer(b"".join(links.to_pylist()), "<u4")
                ends = np.concatenate(([0], np.cumsum(n_groups.to_numpy(zero_copy_only=False))))
                running = [np.concatenate(([0], np.cumsum(v[links]))) for v in values]
                n_best, count_sum = (pa.array(r[ends[1:]] - r[ends[:-1]], pa.int64()) for r in running)
                columns = [ids, n_a, n_b, n_groups, n_groups, n_best, count_sum, digest]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _RESULT.split(", ")])

    ordered = both.repartition("chunk").sortWithinPartitions("chunk", F.col("place").asc_nulls_last())
    return ordered.mapInArrow(run, _RESULT)
