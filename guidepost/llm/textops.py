"""Words and n-grams of many texts at once, as numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# The six blanks that part words: space and 0x09 to 0x0D.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

# A word's bytes weigh by their place, which repeats after so many bytes.
PLACES = 4096
WORDS_AT_ONCE = 1 << 14


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (two rounds of shift and multiply)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, count: int) -> np.ndarray:
    """``count`` fixed odd 64-bit numbers."""
    steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(steps + np.uint64(seed)) | np.uint64(1)


BYTE_VALUE = numbers(11, 256)
PLACE_VALUE = numbers(12, PLACES)


@dataclass
class Words:
    """All words of some texts: bytes ``buf[start:end]``, the text's number and a hash each."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each text, the number of its first word; one more entry at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with a line feed after each, and where each text begins."""
    buf = np.frombuffer(b"\n".join([*(t or b"" for t in texts), b""]), np.uint8)
    sizes = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    return buf, np.concatenate([[0], np.cumsum(sizes)])


def words_of(texts: list[bytes | None]) -> Words:
    buf, begins = joined(texts)
    inside = np.concatenate([[False], ~BLANK[buf], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    first = np.searchsorted(start, begins)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(buf, start, end, text, hashes(buf, start, end), first)


def hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the ascending pieces ``buf[start:end]``, none of them empty."""
    found = np.empty(len(start), np.uint64)
    for a in range(0, len(start), WORDS_AT_ONCE):
        b = min(a + WORDS_AT_ONCE, len(start))
        size = end[a:b] - start[a:b]
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) - np.repeat(ends - size, size)
        chars = buf[np.repeat(start[a:b], size) + place]
        values = BYTE_VALUE[chars] * PLACE_VALUE[place % PLACES]
        found[a:b] = mix64(np.add.reduceat(values, ends - size) + size.astype(np.uint64))
    return found


def grams(hash_: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words that stay in one text, and where each begins."""
    if len(hash_) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    weights = numbers(100 + n, n)
    count = len(hash_) - n + 1
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += hash_[k : k + count] * weights[k]
    at = np.flatnonzero(text[:count] == text[n - 1 :])
    return mix64(total[at]), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """For each key whether it occurs more than once."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[1:] = same
    twice[:-1] |= same
    found = np.empty(len(keys), bool)
    found[order] = twice
    return found


def sums_by_text(values: np.ndarray, words: Words) -> np.ndarray:
    """Sum of a value of each word, by text."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[words.first])
