"""Token counts by prefix dynamic programming over a word-level BPE with word ends.

A token sequence is the BPE of its text exactly if every pair of neighbours is: merging the two alone must give the
two back. So the encoding of a prefix is the encoding of a shorter prefix plus one last token, found by trying the
tokens that end there. ``prefix_counts`` holds, for every prefix of a piece, the count that the library would give for
the text cut there; sums over pieces give the count of any prefix of a text, so truncation and budget questions need
no second encoding. Pieces are remembered per worker in a table of bounded size (it saves time, not results).

A null text has no tokens. The count is a projection of the scan without any shuffle.

An empty table gives an empty result, and other columns of any name do no harm.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regional_balance.llm.common import free_name, slices, texts

#: Words remembered per Python worker; the tables start afresh beyond it.
REMEMBERED = 200_000

#: Control characters that some definitions of white space hold and others don't: such texts are cut by the pattern only.
_SEPARATORS = re.compile("[\x1c-\x1f\x85]")


def byte_alphabet() -> list[str]:
    """The printable stand-in for each byte that byte-level vocabularies use."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class PrefixCounter:
    """Exact prefix counts for the vocabulary of a tokenizers file with NFC, lower case and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: Token text to number: the rank of the merge that makes it, below zero for single symbols.
        self.vocab = {t: -1 - i for i, t in enumerate(model["vocab"])} | {a + b: i for i, (a, b) in enumerate(pairs)}
        self.halves = [(self.vocab[a], self.vocab[b]) for a, b in pairs]
        self.merge = {halves: i for i, halves in enumerate(self.halves)}
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocab)
        self.alphabet = byte_alphabet()
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.known_pairs: dict[tuple[int, int], bool] = {}
        self.known_whole: dict[int, bool] = {}
        self.known_pieces: dict[str, int] = {}
        self.known_words: dict[str, int] = {}
        self.known_states: dict[str, tuple[int, int]] = {}

    def separate(self, left: int, right: int, due: int = 1 << 60) -> bool:
        """True if BPE keeps two tokens apart.

        Their merges are undone, the latest first. A merge across the border happens if it ranks before the merge that
        uses up one of the two symbols at the border; between equal ranks the one further left goes first.
        """
        merge, halves = self.merge, self.halves
        while True:
            across = merge.get((left, right))
            if across is not None and across < due:
                return False
            if left > right:
                if left < 0:
                    return True
                due, left = left, halves[left][1]
            else:
                if right < 0:
                    return True
                due, right = right + 1, halves[right][0]

    def whole(self, token: int) -> bool:
        """True if the BPE of the token's own text is this token."""
        if token < 0:
            return True
        known = self.known_whole.get(token)
        if known is None:
            left, right = self.halves[token]
            known = self.whole(left) and self.whole(right) and self.separate(left, right, token)
            self.known_whole[token] = known
        return known

    def fits(self, before: int, token: int) -> bool:
        known = self.known_pairs
        fit = known.get((before, token))
        if fit is None:
            if len(known) >= 4 * REMEMBERED:
                known.clear()
            fit = known[before, token] = self.separate(before, token)
        return fit

    def states(self, s: str) -> list[tuple[int, int]]:
        """Entry i: last token and token count of the first i symbols, as they stand inside a longer word."""
        known = self.known_states
        n = len(s)
        out = [(0, 0)]
        while len(out) <= n and (state := known.get(s[: len(out)])) is not None:
            out.append(state)
        if len(out) > n:
            return out
        number, fits, longest = self.vocab.get, self.fits, self.longest
        if len(known) >= 2 * REMEMBERED:
            known.clear()
        for i in range(len(out), n + 1):
            for begin in range(i - 1, max(-1, i - longest - 1), -1):
                token = number(s[begin:i])
                if token is not None and (fits(out[begin][0], token) if begin else self.whole(token)):
                    out.append((token, out[begin][1] + 1))
                    break
            if i <= 32:
                known[s[:i]] = out[i]
        return out

    def ended(self, s: str, states: list[tuple[int, int]], i: int) -> int:
        """Tokens of the first i symbols as a whole word: an earlier prefix and one token with the word end."""
        for begin in range(i - 1, max(-1, i - self.longest - 1), -1):
            token = self.vocab.get(s[begin:i] + self.end)
            if token is not None and (self.fits(states[begin][0], token) if begin else self.whole(token)):
                return states[begin][1] + 1
        raise ValueError(f"no encoding of {s[:i]!r}")

    def symbols(self, piece: str) -> str:
        return "".join([self.alphabet[b] for b in piece.encode()])

    def prefix_counts(self, piece: str) -> list[int]:
        """Entry i: tokens of the piece cut after i + 1 bytes, where the cut ends the word."""
        s = self.symbols(piece)
        states = self.states(s[:-1])
        return [self.ended(s, states, i + 1) for i in range(len(s))]

    def count(self, piece: str) -> int:
        """Tokens of a whole piece."""
        n = self.known_pieces.get(piece)
        if n is None:
            s = self.symbols(piece)
            n = self.ended(s, self.states(s[:-1]), len(s))
            if len(piece) <= 64:
                if len(self.known_pieces) >= REMEMBERED:
                    self.known_pieces.clear()
                self.known_pieces[piece] = n
        return n

    def words(self, text: str) -> list[str]:
        """White-space-separated words of the normalised text; strings of special tokens are words of their own."""
        if self.special is None or not any(s in text for s in self.specials):
            return self.plain_words(text)
        found = []
        for k, part in enumerate(self.special.split(text)):
            found += [part] if k % 2 else self.plain_words(part)
        return found

    def plain_words(self, text: str) -> list[str]:
        text = lowered(text)
        return self.pieces.findall(text) if _SEPARATORS.search(text) else text.split()

    def count_word(self, word: str) -> int:
        n = 1 if word in self.specials else sum(map(self.count, self.pieces.findall(word)))
        if len(word) <= 64:
            if len(self.known_words) >= REMEMBERED:
                self.known_words.clear()
            self.known_words[word] = n
        return n

    def counts(self, words: list[str]) -> list[int]:
        get, count = self.known_words.get, self.count_word
        return [get(w) or count(w) for w in words]

    def within(self, text: str, budget: int) -> tuple[int, int]:
        """(whole words, bytes of the next word) of the longest prefix of the text with at most ``budget`` tokens."""
        left, words = budget, self.words(text)
        for k, (word, n) in enumerate(zip(words, self.counts(words))):
            if n > left:
                fit = done = 0
                for piece in [] if word in self.specials else self.pieces.findall(word):
                    inner = self.prefix_counts(piece)
                    fit = max((done + i + 1 for i, c in enumerate(inner) if c <= left), default=fit)
                    left -= inner[-1]
                    done += len(inner)
                    if left < 1:
                        break
                return k, fit
            left -= n
        return len(words), 0


def lowered(text: str) -> str:
    """NFC, then lower case character by character (without the context rule for a final sigma)."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return "".join([c.lower() for c in text]) if "Σ" in text else text.lower()


@functools.cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_words) per row; fit_words: leading words within ``limit`` tokens."""
    key = free_name(docs, "doc_key")
    rows = docs.select(F.col("doc_id").alias(key), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in slices(batches):
            out: list[tuple[int, int, int]] = []
            for text in texts(batch):
                per_word = count.counts(count.words(text))
                total = sum(per_word)
                fit = len(per_word) if total <= limit else sum(t <= limit for t in itertools.accumulate(per_word))
                out.append((len(text.encode()), total, fit))
            n_bytes, n_tokens, fits = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).cast(pa.int64()),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                    pa.array(fits, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_words"],
            )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_words long")
