"""Windows of fixed length, in bytes or in words, and their anchors: which suffixes of a text an index needs."""

from __future__ import annotations

from functools import cache

import numpy as np
import xxhash

from regional_balance.llm.fingerprints import WINDOW, gear_hash


#: Windows worked on at once; runs also end where such a stretch does.
STRETCH = 1 << 20
#: Words at an anchor of word windows.
SHINGLE = 5
#: An odd number and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
KEPT_POWERS = 1 << 16


def anchored_runs(raw: bytes, length: int) -> list[tuple[int, int, int]]:
    """(first, last, anchor) of runs of window starts whose windows have the same anchor.

    The anchor of a window is where the smallest gear hash of 32 bytes inside it begins, the first of equals; it depends
    on the window's bytes alone, so equal windows have it at the same place.
    """
    out: list[tuple[int, int, int]] = []
    for at in range(0, len(raw) - length + 1, STRETCH):
        part = raw[at : at + STRETCH + length - 1]
        out += [(at + first, at + last, at + anchor) for first, last, anchor in stretch_runs(part, length)]
    return out


def stretch_runs(raw: bytes, length: int) -> list[tuple[int, int, int]]:
    return least_runs(gear_hash(raw)[WINDOW - 1 :], length - WINDOW + 1)


def least_runs(hashes: np.ndarray, span: int) -> list[tuple[int, int, int]]:
    """(first, last, place) of runs of starts whose next ``span`` 32-bit hashes have the smallest, the first of equals, at the same place."""
    n = len(hashes) - span + 1
    low = hashes.astype(np.uint64) << np.uint64(32)
    low |= np.arange(len(low), dtype=np.uint64)
    step = 1
    while 2 * step <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < span:
        low = np.minimum(low[:n], low[span - step : span - step + n])
    anchors = (low[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edges = np.flatnonzero(np.diff(anchors)) + 1
    firsts = np.concatenate(([0], edges))
    lasts = np.concatenate((edges - 1, [n - 1]))
    return list(zip(firsts.tolist(), lasts.tolist(), anchors[firsts].tolist()))


def run_hashes(raw: bytes, runs: list[tuple[int, int, int]], length: int) -> tuple[list[int], list[int]]:
    """(hash of the anchor's 32 bytes, hash of all bytes that the run's windows cover) of each run."""
    digest = xxhash.xxh3_64_intdigest
    keys = [digest(raw[a : a + WINDOW]) for _, _, a in runs]
    return keys, [digest(raw[first : last + length]) for first, last, _ in runs]


def words_of(raw: bytes) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+``: bytes are split at just these."""
    return raw.split()


def word_places(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text with one space between words."""
    spaces = np.flatnonzero(np.frombuffer(body, np.uint8) == 32)
    return np.concatenate(([0], spaces + 1)), np.concatenate((spaces, [len(body)]))


def shingle_hashes(body: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each ``SHINGLE`` words: of their bytes alone, wherever they stand."""
    codes = np.frombuffer(body, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers(BASE, len(body)), dtype=np.uint64)))
    h = (sums[ends[SHINGLE - 1 :]] - sums[starts[: len(starts) - SHINGLE + 1]]) * powers(INVERSE, len(body))[starts[: len(starts) - SHINGLE + 1]]
    h ^= h >> np.uint64(29)
    return (h * np.uint64(BASE)) >> np.uint64(32)


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a number modulo 2**64; those for texts of usual size are kept."""
    return kept_powers(base)[:n] if n <= KEPT_POWERS else first_powers(base, n)


@cache
def kept_powers(base: int) -> np.ndarray:
    return first_powers(base, KEPT_POWERS)


def first_powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
    return out[:n]


def word_runs(raw: bytes, length: int) -> tuple[list[tuple[int, int, int]], list[int], list[int]]:
    """Runs of starts of windows of ``length`` words, as ``anchored_runs``, with the hashes of their anchors and of all they cover.

    The anchor of a window is the ``SHINGLE`` words with the smallest hash in it; white space between words does not count.
    """
    words = words_of(raw)
    runs, keys, wholes = [], [], []
    for at in range(0, len(words) - length + 1, STRETCH):
        body = b" ".join(words[at : at + STRETCH + length - 1])
        starts, ends = word_places(body)
        found = least_runs(shingle_hashes(body, starts, ends), length - SHINGLE + 1)
        starts, ends = starts.tolist(), ends.tolist()
        runs += [(at + first, at + last, at + anchor) for first, last, anchor in found]
        # Seeded, so that they differ from hashes of byte windows.
        keys += [xxhash.xxh3_64_intdigest(body[starts[a] : ends[a + SHINGLE - 1]], 1) for _, _, a in found]
        wholes += [xxhash.xxh3_64_intdigest(body[starts[first] : ends[last + length - 1]], 1) for first, last, _ in found]
    return runs, keys, wholes
