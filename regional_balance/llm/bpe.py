"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode`` adds ids, ``decode`` turns ids back into bytes, ``round_trip`` does both and returns digests only. All are
projections of the scan: nothing is shuffled, and a lost task is run again from its input split.

A null text counts as empty (no ids). Repeated rows are encoded like any others, an empty table gives an empty table,
and columns other than those named are carried by ``encode`` unchanged.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from regional_balance.llm.common import free_name, slices, texts

#: Texts longer than this are encoded part by part. It bounds the pre-splitter's working memory, not the result.
PART_CHARS = 1 << 16

#: A part may end before white space that follows a visible character: no match of the split pattern goes across,
#: since a match with a visible character ends before the next white space.
_SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])")


@functools.cache
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The library's encoder for a rank file (base64 token and rank on each line), one per Python worker."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut a text at safe boundaries into parts of about ``size`` characters; a part without a boundary stays whole."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode_text(enc: tiktoken.Encoding, text: str, size: int = PART_CHARS) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for part in safe_parts(text, size) for i in enc.encode_ordinary(part)]


def encode(docs: DataFrame, ranks: str, pattern: str, out: str = "ids") -> DataFrame:
    """``docs`` with ``out``, the array of token ids of ``text``. An existing column of that name is replaced."""
    base = docs.drop(out)
    schema = base.withColumn(out, F.array().cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in slices(batches):
            ids = pa.array([encode_text(enc, t) for t in texts(batch)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, out])

    return base.mapInArrow(run, schema)


def decode(rows: DataFrame, ranks: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``rows`` with ``out``, the raw bytes that ``ids`` stand for (null ids: no bytes). Replaces an existing ``out``."""
    base = rows.drop(out)
    schema = base.withColumn(out, F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in slices(batches):
            raw = pa.array([enc.decode_bytes(x or []) for x in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], [*batch.schema.names, out])

    return base.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: str, pattern: str, carry: Sequence[str] = (), ids: str | None = None) -> DataFrame:
    """(doc_id, carried columns, n_tokens, ids_sha256, decoded_sha256) per row: encoding and decoding in one pass.

    With ``ids`` the token ids come as well, in an array of that name. Only slices of a batch are held as ids.
    """
    key = free_name(docs, "doc_key")
    rows = docs.select(F.col("doc_id").cast("long").alias(key), *carry, "text")
    fields = [StructField("doc_id", LongType()), *(docs.schema[c] for c in carry), StructField("n_tokens", LongType())]
    fields += [StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    fields += [StructField(ids, ArrayType(IntegerType()))] if ids else []
    schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in slices(batches, 64):
            found = [encode_text(enc, t) for t in texts(batch)]
            columns = [
                batch.column(key),
                *(batch.column(c) for c in carry),
                pa.array(map(len, found), pa.int64()),
                pa.array([hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in found], pa.string()),
                pa.array([hashlib.sha256(enc.decode_bytes(x)).hexdigest() for x in found], pa.string()),
            ]
            columns += [pa.array(found, pa.list_(pa.int32()))] if ids else []
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)
