"""Token ids in binary files of directly addressable codes.

Ids are cut into chunks of eight bits. Level 0 holds the lowest chunk of every id, level 1 the next chunk of those ids
that have one, and so on. A bitmap beside each level says which ids go on, and a directory of its running popcounts gives the
place in the next level, so that ``access`` reads any token from a few bytes without decoding a block.

Documents go to files in ascending doc_id (null last, equal ids by text hash). Each range of ids is written by its own
task as segments of about ``segment_tokens`` ids; a segment (one file image, column ``image``) holds whole documents and
their directory. Segments are rows of a Parquet table, so commit and recovery are those of Spark's writer.

A null text counts as empty; such a document holds the end id alone. Repeated rows are separate documents.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regional_balance.llm.common import free_name, partitions, slices, store, text_column

MAGIC = b"DAC1"
BLOCK = 512  # bits per entry of a rank directory
REMEMBERED, REMEMBERED_PIECES = 1_200_000, 100_000

#: Bytes of text whose words are looked up together.
PORTION = 4 << 20

#: Control characters of which definitions of white space differ.
_UNSURE = re.compile("[\x1c-\x1f\x85]")

#: A pre-token of letters, and one of marks after it or none: words that need no look at the whole split.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")

#: The split of the byte-level pre-tokenizer (fixed value).
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def pack(ids: np.ndarray) -> bytes:
    """Levels of a sequence of unsigned 32-bit integers."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(rest) // BLOCK) * BLOCK, bool)
        padded[: len(rest)] = more
        ranks = np.concatenate(([0], np.cumsum(padded.reshape(-1, BLOCK).sum(axis=1))))[:-1] if len(rest) else np.zeros(0)
        levels.append((len(rest), (rest & 255).astype(np.uint8).tobytes(), bits.tobytes(), ranks.astype("<u8").tobytes()))
        rest = rest[more] >> 8
        if not len(rest):
            break
    head = struct.pack("<I", len(levels)) + b"".join(struct.pack("<Q", level[0]) for level in levels)
    return head + b"".join(part for level in levels for part in level[1:])


def levels(image: bytes, at: int = 0) -> tuple[list[tuple[int, int, int, int]], int]:
    """((length, offset of codes, of bitmap, of rank directory) of each level, offset after the last)."""
    (n_levels,) = struct.unpack_from("<I", image, at)
    sizes = struct.unpack_from(f"<{n_levels}Q", image, at + 4)
    at += 4 + 8 * n_levels
    out = []
    for n in sizes:
        bitmap = at + n
        ranks = bitmap + (n + 7) // 8
        out.append((n, at, bitmap, ranks))
        at = ranks + 8 * -(-n // BLOCK)
    return out, at


def access(image: bytes, i: int, at: int = 0) -> int:
    """The integer at position ``i``, from one byte, one bit and one rank per level."""
    value = 0
    for k, (n, codes, bitmap, ranks) in enumerate(levels(image, at)[0]):
        if not 0 <= i < n:
            raise IndexError(i)
        value |= image[codes + i] << (8 * k)
        if not image[bitmap + i // 8] >> (i % 8) & 1:
            break
        block = i // BLOCK
        (rank,) = struct.unpack_from("<Q", image, ranks + 8 * block)
        before = int.from_bytes(image[bitmap + block * BLOCK // 8 : bitmap + i // 8 + 1], "little")
        i = rank + (before & ((1 << (i - block * BLOCK)) - 1)).bit_count()
    return value


def unpack(image: bytes, at: int = 0) -> np.ndarray:
    """All integers of a sequence."""
    parts, _ = levels(image, at)
    out, place = np.zeros(parts[0][0], np.uint32), None
    for k, (n, codes, bitmap, _) in enumerate(parts):
        chunk = np.frombuffer(image, np.uint8, n, codes).astype(np.uint32) << np.uint32(8 * k)
        if place is None:
            out |= chunk
        else:
            out[place] |= chunk
        if k + 1 < len(parts):
            more = np.unpackbits(np.frombuffer(image, np.uint8, (n + 7) // 8, bitmap), count=n, bitorder="little").view(bool)
            place = np.flatnonzero(more) if place is None else place[more]
    return out


def image_of(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A segment: document ids with a null mask, token counts per document, token ids."""
    known = np.array([d is not None for d in doc_ids], np.uint8)
    raw = np.array([d or 0 for d in doc_ids], "<i8")
    return MAGIC + struct.pack("<Q", len(doc_ids)) + known.tobytes() + raw.tobytes() + pack(np.array(counts)) + pack(ids)


def documents_of(image: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, token ids) of each document of a segment, in order."""
    if image[:4] != MAGIC:
        raise ValueError("not a token file")
    (n,) = struct.unpack_from("<Q", image, 4)
    known = np.frombuffer(image, np.uint8, n, 12)
    raw = np.frombuffer(image, "<i8", n, 12 + n)
    at = 12 + 9 * n
    ends = np.cumsum(unpack(image, at), dtype=np.int64)
    ids = unpack(image, levels(image, at)[1])
    for k in range(n):
        yield int(raw[k]) if known[k] else None, ids[ends[k - 1] if k else 0 : ends[k]]


class Pieces(dict):
    """Ids of a pre-token, as little-endian unsigned 32-bit integers; computed by the library's model when first asked for."""

    def __init__(self, model, letters: str, size: int):
        super().__init__()
        self.tokenize, self.letters = model.tokenize, letters
        self.codes = [i.to_bytes(4, "little") for i in range(size)]

    def ids(self, piece: str) -> bytes:
        return self.of_letters(codecs.charmap_decode(piece.encode(), "strict", self.letters)[0])

    def of_letters(self, shown: str) -> bytes:
        """Ids of a pre-token given as one letter for each of its bytes."""
        codes = self.codes
        return b"".join([codes[t.id] for t in self.tokenize(shown)])

    def __missing__(self, piece: str) -> bytes:
        ids = self.ids(piece)
        if len(self) >= REMEMBERED_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Words(dict):
    """Ids of a word with the space before it, put together from those of its pre-tokens when first asked for.

    A word that ends in white space has no ids here: the cut after it would not be one of the pre-tokenizer's.
    """

    def __init__(self, pieces: Pieces, split: regex.Pattern):
        super().__init__()
        self.pieces, self.split, self.space = pieces, split, pieces.letters[32]

    def __missing__(self, word: str) -> bytes | None:
        ids = None
        if word.isascii() and word.isalpha():  # such letters stand for themselves
            ids = self.pieces.of_letters(self.space + word)
        elif plain := _PLAIN.fullmatch(word):
            letters, marks = plain.groups()
            ids = self[letters] + self.pieces[marks] if marks else self.pieces.ids(" " + letters)
        elif word and not word[-1].isspace() and not _UNSURE.search(word):
            first, *rest = self.split.findall(" " + word)
            # Its first pre-token is most often a word that also stands alone.
            ids = self[first[1:]] if rest and not first.isspace() else self.pieces.ids(first)
            ids += b"".join([self.pieces[piece] for piece in rest])
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids


class Encoder:
    """The tokenizers library, with the ids of recent words kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        spare = itertools.count(256)
        letters = "".join([chr(b) if b in shown else chr(next(spare)) for b in range(256)])
        self.words = Words(Pieces(self.library.model, letters, max(self.library.get_vocab().values()) + 1), _SPLIT)

    def first(self, word: str) -> bytes | None:
        """Ids of the first word of a text, which has no space before it."""
        if word and (word[-1].isspace() or _UNSURE.search(word)):
            return None
        return b"".join([self.words.pieces[piece] for piece in _SPLIT.findall(word)])

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of one text as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, column: pa.Array) -> list[bytes]:
        """Ids of each text; the words that the texts share are looked up once for all of them.

        A space after a visible character starts a new pre-token whatever surrounds it, so a text is cut there and
        each word encoded once. Texts in which that does not hold everywhere go to the library in one piece.
        """
        lists = pc.split_pattern(column, " ")
        special = np.zeros(len(column), bool)
        for s in self.specials:
            special |= pc.match_substring(column, s).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places, ends = coded.indices.to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())
        after_space = np.zeros(len(distinct), bool)
        after_space[np.delete(places, np.concatenate(([0], ends[:-1])))] = True
        found = [self.words[word] if spaced else None for word, spaced in zip(distinct, after_space.tolist())]
        out, at = [], 0
        for k, end in enumerate(ends.tolist()):
            ids = None if special[k] else self.first(distinct[places[at]])
            rest, at = places[at + 1 : end], end
            if ids is not None:
                try:
                    ids += b"".join(map(found.__getitem__, rest.tolist()))
                except TypeError:  # a word without ids
                    ids = None
            out.append(self.whole(column[k].as_py()) if ids is None else ids)
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def portions(batch: pa.RecordBatch, name: str, size: int = PORTION) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``size`` bytes of text each, one row at least."""
    ends, at = np.cumsum(pc.binary_length(batch.column(name)).to_numpy().astype(np.int64)), 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def write_token_files(docs: DataFrame, path: str, end_id: int = 0, segment_tokens: int = 1 << 20) -> DataFrame:
    """Encode documents into segment files in the shared folder and return the table of segments.

    (part, seq, n_docs, n_tokens, image): ``part`` numbers ranges of doc_id upwards, ``seq`` the segments of a range.
    """
    key, text = free_name(docs, "doc_key"), free_name(docs, "doc_text")
    rows = docs.select(F.col("doc_id").cast("long").alias(key), text_column().alias(text))
    order = [F.col(key).asc_nulls_last(), F.xxhash64(text)]  # sampled keys go to the driver, so they hold no texts
    rows = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order, text)
    rows = rows.withColumn("part", F.spark_partition_id())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seq, part = encoder(path), 0, 0
        doc_ids: list[int | None] = []
        encoded: list[bytes] = []
        held = 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(encoded), "<u4")
            image = image_of(doc_ids, [len(x) // 4 for x in encoded], ids)
            values = [[part], [seq], [len(doc_ids)], [len(ids)], [image]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, kinds)], ["part", "seq", "n_docs", "n_tokens", "image"]
            )

        for batch in (portion for batch in batches for portion in portions(batch, text)):
            part = batch.column("part")[0].as_py()
            for doc, ids in zip(batch.column(key).to_pylist(), enc.encode_all(batch.column(text))):
                doc_ids.append(doc)
                encoded.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= segment_tokens:
                    yield segment()
                    seq, held, doc_ids, encoded = seq + 1, 0, [], []
        if doc_ids:
            yield segment()

    files = rows.mapInArrow(run, "part int, seq int, n_docs long, n_tokens long, image binary")
    return store(files, "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the segment files.

    ``start`` counts the ids of all documents before; it adds up range totals, then segment totals within a range.
    """
    ranges = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each write task
    ranges = ranges.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("segment_start"))
    offsets = offsets.join(ranges, "part").select("part", "seq", (F.col("range_start") + F.col("segment_start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            part, seq = batch.column("part")[0].as_py(), batch.column("seq")[0].as_py()
            found, start = [], 0
            for doc, ids in documents_of(batch.column("image")[0].as_py()):
                found.append((doc, part, seq, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "part", "seq", "local", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), kinds)], names)

    rows = files.select("part", "seq", "image").mapInArrow(
        run, "doc_id long, part int, seq int, local long, n_tokens long, ids_crc32 long"
    )
    return rows.join(offsets, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )
