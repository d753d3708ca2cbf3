"""Removal of repeated byte strings, and words in repeated passages, with a logarithmic family of suffix indexes.

A window is a string of ``length`` bytes inside one text, or of ``words`` words, whatever white space is between them; both
kinds go through the same index, with hashes of their own. What windows of bytes cover is removed, what windows of words cover
is counted. The index holds a sparse suffix array: of all suffixes of a text only those at anchors (see ``suffixes``), one for
each run of window starts that share their anchor. Suffixes are named by the hash of their first 32 bytes (or five words) and
the hash of all bytes the run covers and matched by these names: hashing takes the place of byte order, which equal strings of
a fixed length do not need. New batches of texts get such an array, whose keys are matched with those of every level of the
family; then it becomes a level (names and numbers only; places are looked up in the runs once the matches are known), and
levels of equal size are merged at once into one of the next size, so that n batches leave log n levels and each entry is
rewritten log n times at most. Matches are kept as keys, and a merged level's parts are deleted: each entry is on disk once
between batches.

What a scan tells of a run: another run covers the same bytes, so all its windows repeat; or another run has the same
first bytes only, so some may; or nothing matches, so none does. For the second case, entries with the same key are compared
window by window. Groups up to ``GROUP`` entries are compared from their bytes; for the entries of larger ones a row
for each window is dealt out by its hash, so that no group of any size has to fit in memory.

Windows are judged on the input. Null text counts as empty; texts shorter than a window have none and stay whole.
Rows with the same doc_id and text are repeats of each other. Nothing matches across texts.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance.llm.common import discard, partitions, same, slices, store, stored, text_column
from regional_balance.llm.suffixes import anchored_runs, run_hashes, word_places, word_runs, words_of

#: Entries of one key that a task compares from their bytes (some 600 bytes each).
GROUP = 4096
#: Batches follow the input, so many bytes of text each. Each is compared with all levels: few large ones, so that it is not all to all.
BATCH_BYTES = 8 << 30
#: With four batches levels of one and of two batches merge.
LEAST_BATCHES = 4


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text) of every row; id and hash name a text in all that follows."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_column()).alias("text_hash"), text_column().alias("text"))


def runs_of(texts: DataFrame, length: int, words: int) -> DataFrame:
    """(doc_id, text_hash, of_words, first, last, key, whole): a row for each run of windows with one anchor, of bytes and of words."""
    names = ["doc_id", "text_hash", "of_words", "first", "last", "key", "whole"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            which, kinds, firsts, lasts, keys, wholes = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = text.encode()
                found = anchored_runs(raw, length)
                for of_words, (own, own_keys, own_wholes) in enumerate([(found, *run_hashes(raw, found, length)), word_runs(raw, words)]):
                    which += [i] * len(own)
                    kinds += [bool(of_words)] * len(own)
                    firsts += [f for f, _, _ in own]
                    lasts += [x for _, x, _ in own]
                    keys += own_keys
                    wholes += own_wholes
            rows = pa.array(which, pa.int64())
            ints = [pa.array(v, pa.int32()) for v in (firsts, lasts)]
            signed = [pa.array(np.array(v, np.uint64).view(np.int64)) for v in (keys, wholes)]
            columns = [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(kinds, pa.bool_()), *ints, *signed]
            yield pa.RecordBatch.from_arrays(columns, names)

    return texts.mapInArrow(run, "doc_id long, text_hash long, of_words boolean, first int, last int, key long, whole long")


def suffix_array(runs: DataFrame) -> DataFrame:
    """(key, whole, n): the distinct suffixes of a batch with their number."""
    return runs.groupBy("key", "whole").agg(F.count("*").alias("n"))


class IndexFamily:
    """Levels of 1, 2, 4, ... batches, each a stored table of suffixes. Levels merge as soon as equal ones meet."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.paths: list[str] = []
        self.hits: list[tuple[DataFrame, str]] = []

    def add(self, runs: DataFrame) -> None:
        """Index a batch; keep the keys in it whose first bytes occur more than once, in it and the levels."""
        new, path = stored(suffix_array(runs), "suffixes")
        seen = new.select("key", "n", F.lit(True).alias("fresh"))
        for _, level in self.levels:
            seen = seen.union(level.select("key", "n", F.lit(False).alias("fresh")))
        totals = seen.groupBy("key").agg(F.sum("n").alias("total"), F.max("fresh").alias("fresh"))
        self.hits.append(stored(totals.where("total > 1 AND fresh").select("key"), "hits"))
        self.levels.append((1, new))
        self.paths.append(path)
        self.merge()

    def merge(self) -> None:
        """Merge the last levels while two hold equally many batches: one pass over all that end up in one level."""
        if not self.levels:
            return
        first, size = len(self.levels) - 1, self.levels[-1][0]
        while first > 0 and self.levels[first - 1][0] == size:
            first, size = first - 1, 2 * size
        if first == len(self.levels) - 1:
            return
        level, path = stored(self.summed([level for _, level in self.levels[first:]]), "suffixes")
        discard(level.sparkSession, self.paths[first:])
        self.levels[first:], self.paths[first:] = [(size, level)], [path]

    @staticmethod
    def summed(levels: list[DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.union, levels)
        return rows.groupBy("key", "whole").agg(F.sum("n").alias("n"))

    def known(self) -> DataFrame:
        """(key, whole, n) of all suffixes whose first bytes occur more than once."""
        keys = reduce(DataFrame.union, [found for found, _ in self.hits])
        return self.summed([level.join(keys, "key", "left_semi") for _, level in self.levels])

    def discard(self) -> None:
        if self.levels:
            discard(self.levels[0][1].sparkSession, [*self.paths, *(path for _, path in self.hits)])
        self.levels, self.paths, self.hits = [], [], []


def window_digests(body: bytes, length: int) -> list[bytes]:
    return [xxhash.xxh3_128_digest(body[i : i + length]) for i in range(len(body) - length + 1)]


def word_window_digests(body: bytes, words: int) -> list[bytes]:
    """As ``window_digests``, of a text with one space between words."""
    starts, ends = (v.tolist() for v in word_places(body))
    return [xxhash.xxh3_128_digest(body[a:b]) for a, b in zip(starts, ends[words - 1 :])]


def merged_starts(starts: list[int]) -> list[tuple[int, int]]:
    """Runs of consecutive numbers in an ascending list."""
    out: list[list[int]] = []
    for s in starts:
        if out and s == out[-1][1] + 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [tuple(r) for r in out]


def repeated_windows(entries: DataFrame, texts: DataFrame, length: int, words: int) -> DataFrame:
    """(doc_id, text_hash, of_words, first, last): window starts of the entries that occur in another entry of the same key.

    ``entries``: (key, group_size, entry), distinct in what they cover. A text that several rows share comes in as often;
    its windows do repeat then.
    """
    wanted = entries.select("entry.doc_id", "entry.text_hash", F.struct("key", "group_size", "entry.of_words", "entry.first", "entry.last").alias("e"))
    wanted = wanted.groupBy(F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash")).agg(F.collect_set("e").alias("found"))
    rows = texts.join(wanted, same(F.col("doc_id"), F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))).drop("w_id", "w_hash")

    def digests_of(body: bytes, of_words: bool) -> list[bytes]:
        return word_window_digests(body, words) if of_words else window_digests(body, length)

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out: list[tuple] = []
            for i, (text, found) in enumerate(zip(batch.column("text").to_pylist(), batch.column("found").to_pylist())):
                raw = text.encode()
                split = words_of(raw) if any(e["of_words"] for e in found) else []
                for e in found:
                    if e["of_words"]:
                        body = b" ".join(split[e["first"] : e["last"] + words])
                    else:
                        body = raw[e["first"] : e["last"] + length]
                    if e["group_size"] <= GROUP:
                        out.append((i, 2 * e["of_words"], e["key"], body, e["first"]))
                        continue
                    for at, digest in enumerate(digests_of(body, e["of_words"]), e["first"]):
                        out.append((i, 2 * e["of_words"] + 1, int.from_bytes(digest[:8], "little", signed=True), digest, at))
            which, kinds, groups, parts, at = zip(*out) if out else ([],) * 5
            chosen = pa.array(which, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(chosen),
                    batch.column("text_hash").take(chosen),
                    pa.array(kinds, pa.int32()),
                    pa.array(groups, pa.int64()),
                    pa.array(parts, pa.binary()),
                    pa.array(at, pa.int32()),
                ],
                ["doc_id", "text_hash", "kind", "group", "body", "at"],
            )

    dealt = rows.mapInArrow(bodies, "doc_id long, text_hash long, kind int, group long, body binary, at int")
    dealt = dealt.repartition(partitions(texts.sparkSession), "kind", "group").sortWithinPartitions("kind", "group", "body")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the entries of one key, or one row of a window not known to repeat
        name, repeats = None, False

        def flush() -> list[tuple]:
            if not held or name[0] % 2:
                return []
            of_words = name[0] == 2
            digests = [digests_of(body, of_words) for _, _, body, _ in held]
            seen = Counter(d for own in digests for d in own)
            out = []
            for (doc, text_hash, _, at), own in zip(held, digests):
                out += [(doc, text_hash, of_words, at + a, at + b) for a, b in merged_starts([i for i, d in enumerate(own) if seen[d] > 1])]
            return out

        for batch in slices(batches, 1024):
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "kind", "group", "body", "at")]
            for doc, text_hash, kind, group, body, at in zip(*columns):
                own = (kind, body) if kind % 2 else (kind, group)
                if own != name:
                    out += flush()
                    held, name, repeats = [], own, False
                if kind % 2 == 0:
                    held.append((doc, text_hash, body, at))
                    continue
                one = (doc, text_hash, kind == 3, at, at)
                if not held:
                    held = [one]
                else:
                    out += [one] if repeats else [held[0], one]
                    repeats = True
            yield spans(out)
        yield spans(flush())

    def spans(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text_hash", "of_words", "first", "last"])

    return dealt.mapInArrow(compare, "doc_id long, text_hash long, of_words boolean, first int, last int")


def batches_for(texts: DataFrame, batch_bytes: int) -> int:
    """How many batches of about ``batch_bytes`` bytes of text there are, ``LEAST_BATCHES`` at least."""
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(LEAST_BATCHES, -(-total // batch_bytes))


def repeats(texts: DataFrame, length: int, words: int, batches: int) -> DataFrame:
    """(doc_id, text_hash, of_words, first, last): runs of starts of windows that occur elsewhere too."""
    runs = runs_of(texts, length, words).withColumn("batch", F.pmod("text_hash", F.lit(batches)).cast("int"))
    runs = store(runs, "runs", by="batch")
    family = IndexFamily()
    for b in range(batches):
        family.add(runs.where(F.col("batch") == b))
    known = store(family.known(), "known")
    family.discard()
    sizes = known.groupBy("key").agg(F.count("*").alias("group_size"))
    matched = store(runs.drop("batch").join(known.join(sizes, "key"), ["key", "whole"]), "matched")
    whole = matched.where("n > 1")
    entry = F.min(F.struct("doc_id", "text_hash", "of_words", "first", "last")).alias("entry")
    entries = matched.where("group_size > 1").groupBy("key", "whole", "group_size").agg(entry)
    some = repeated_windows(entries, texts, length, words)
    return whole.select("doc_id", "text_hash", "of_words", "first", "last").union(some)


def union_of(starts: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal ranges of bytes or words covered by windows, from runs of their starts."""
    out: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in starts):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [tuple(r) for r in out]


def remove_repeats(docs: DataFrame, length: int = 400, words: int = 50, batches: int | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words, kept) for every row; ``kept`` is what remains, as bytes.

    ``n_passage_words`` are the words covered by ``words`` words in a row that also start anywhere else, which may be fewer bytes
    than ``length``: they are told, not removed. Without ``batches`` their number follows the input, by ``batch_bytes``.
    """
    texts = keyed(docs)
    found = repeats(texts, length, words, batches or batches_for(texts, batch_bytes))
    starts = F.collect_set(F.struct("of_words", "first", "last")).alias("starts")
    found = found.groupBy(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash")).agg(starts)
    # In one plan with the texts' join in repeated_windows, so that they cross the same exchange once.
    rows = texts.join(found, same(F.col("doc_id"), F.col("f_id")) & (F.col("text_hash") == F.col("f_hash")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc, text, starts in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                raw = text.encode()
                spans = union_of([s for s in starts or [] if not s["of_words"]], length)
                passages = union_of([s for s in starts or [] if s["of_words"]], words)
                ends = [0, *(e for _, e in spans)]
                kept = b"".join(raw[a:b] for a, b in zip(ends, [*(s for s, _ in spans), len(raw)]))
                n_words = sum(b - a for a, b in passages)
                out.append((doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), n_words, kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long, kept binary"
    return rows.select("doc_id", "text", "starts").mapInArrow(cut, schema)
