"""Byte-level BPE with a queue of merge ranks.

A text is cut into pre-tokens by a pattern; each is merged by itself. The parts of a
pre-token are a linked list of positions. A merge rank has a bucket of the positions whose pair
it would merge; a hierarchical bitmap (words of 64 bits, a bit above for each word that is not zero)
knows which buckets have entries, so the lowest rank is found by three find-first-sets, whatever the
length. Entries whose pair has changed since are stale and skipped. The work is
proportional to the length of a pre-token, up to the logarithm of late entries in a bucket, so
pre-tokens of many megabytes are no special case.

Pre-tokens that were not met before go through one queue together: as no pair crosses their
borders, each is merged in the order that it would have alone.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from guidepost.functions import column
from guidepost.llm.frames import Kept, blocks, fresh, id_and_bytes

# The vocabulary goes to every worker; a file beyond this is no vocabulary.
VOCABULARY_BYTES = 64 * 1024 * 1024
PIECES_AT_ONCE = 1 << 16
# What is known of pre-tokens is forgotten when they hold so many bytes.
KNOWN_BYTES = 12 * 1024 * 1024
# Room that a pre-token takes besides its bytes, in units of them.
PIECE_BYTES = 16
# Beyond this many bytes the lists are arrays, which are slower and take a seventh of the room.
LISTED = 1 << 22

WORD_BITS = 6
# A private character, neither letter nor digit nor blank, as all unassigned ones.
STAND_IN = ""


class RankQueue:
    """Buckets of positions by rank. A bucket is a stretch of ``positions``, sorted beforehand, and
    a heap of those that came later; a bit of ``levels`` tells whether it has any."""

    def __init__(self, ranks: int):
        sizes = [ranks]
        while sizes[-1] > 1:
            sizes.append((sizes[-1] + 63) >> WORD_BITS)
        self.levels = [[0] * size for size in sizes[1:]]
        self.early: dict[int, tuple[int, int]] = {}
        self.late: dict[int, list[int]] = {}

    def mark(self, rank: int) -> None:
        for words in self.levels:
            word, bit = rank >> WORD_BITS, 1 << (rank & 63)
            if words[word] & bit:
                return
            words[word] |= bit
            rank = word

    def _clear(self, rank: int) -> None:
        for words in self.levels:
            word = rank >> WORD_BITS
            words[word] &= ~(1 << (rank & 63))
            if words[word]:
                return
            rank = word

    def first(self) -> int:
        """The lowest rank with entries, or -1."""
        if not self.levels[-1][0]:
            return -1
        rank = 0
        for words in reversed(self.levels):
            word = words[rank]
            rank = (rank << WORD_BITS) | ((word & -word).bit_length() - 1)
        return rank

    def load(self, ranks: np.ndarray) -> np.ndarray:
        """Enter position i under ``ranks[i]`` for all i, if not below zero; the sorted positions."""
        order = np.argsort(ranks, kind="stable").astype(np.int32)
        order = order[np.searchsorted(ranks, 0, sorter=order) :]
        found, begin = np.unique(ranks[order], return_index=True)
        ends = [*begin[1:].tolist(), len(order)]
        for rank, start, end in zip(found.tolist(), begin.tolist(), ends):
            self.early[rank] = (start, end)
            self.mark(rank)
        return order

    def take(self, rank: int) -> tuple[int, int, list[int]]:
        """Empty a bucket: where its sorted stretch begins and ends, and its heap."""
        self._clear(rank)
        return (*self.early.pop(rank, (0, 0)), self.late.pop(rank, []))

    def put_back(self, rank: int, start: int, end: int, late: list[int]) -> None:
        if start < end:
            self.early[rank] = (start, end)
        if late:
            self.late[rank] = late
        if start < end or late:
            self.mark(rank)


def _listed(values: np.ndarray) -> list[int] | array:
    if len(values) < LISTED:
        return values.tolist()
    return array("i", values.astype(np.int32).tobytes())


class Vocabulary:
    """Ranks of byte strings, and how texts are cut before they are merged.

    A text is a Python string; what the pattern does not match is left out, as the public
    library does. Character classes are those of that library, whose Unicode version may
    differ from that of the pattern's module: a letter or digit that only the latter knows is
    replaced by a private character while the text is cut.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, unknown: np.ndarray):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.tokens}
        self.pattern = regex.compile(pattern)
        self.singles = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = np.full(1 << 16, -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank
        # The rank that two neighbouring parts have together, by both of their ranks.
        self.shift = max(self.tokens).bit_length()
        self.joins: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.joins[left << self.shift | right] = rank
        self.unknown = unknown
        self.queue = RankQueue(max(self.tokens) + 1)
        self._forget()

    def _forget(self) -> None:
        """Of pre-tokens met before: their ranks, in decimal, and the bytes they stand for. Texts and
        bytes, as millions of small lists would keep the garbage collector busy."""
        self.told: dict[str, str] = {}
        self.content: dict[str, bytes] = {}
        self.held = 0

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, in order, some ten thousand at a time."""
        cut = text
        if not text.isascii():
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            strange = np.flatnonzero(self.unknown[codes])
            if len(strange):
                codes = codes.copy()
                codes[strange] = ord(STAND_IN)
                cut = codes.tobytes().decode("utf-32-le")
        if cut is text and len(text) <= PIECES_AT_ONCE:
            yield self.pattern.findall(text)
            return
        places = (match.span() for match in self.pattern.finditer(cut))
        while block := [text[a:b] for a, b in islice(places, PIECES_AT_ONCE)]:
            yield block

    def merged(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        """The ranks of the parts of all pre-tokens that are left when no pair can be merged, and
        where each pre-token's begin, with one more entry at the end."""
        queue, joins, shift = self.queue, self.joins, self.shift
        buckets, early, mark = queue.late, queue.early, queue.mark
        text = b"".join(pieces)
        size = len(text)
        borders = np.cumsum([0, *map(len, pieces)])
        codes = np.frombuffer(text, np.uint8).astype(np.int32)
        # Of the part that begins at i: its rank (below zero: no part begins there), where it ends,
        # where the part before begins, and the rank that it and the next would have.
        own = _listed(self.singles[codes])
        after = _listed(np.arange(1, size + 1))
        places = np.arange(-1, size - 1)
        places[borders[:-1][borders[:-1] < size]] = -1
        before = _listed(places)
        found = np.full(size, -1, np.int32)
        found[:-1] = self.pairs[codes[:-1] << 8 | codes[1:]]
        found[borders[1:][borders[1:] > 0] - 1] = -1
        positions = _listed(queue.load(found))
        pair = _listed(found)
        first = bytearray(size + 1)  # 1 where a pre-token begins
        np.frombuffer(first, np.uint8)[borders] = 1

        while (lowest := queue.first()) >= 0:
            start, end, late = queue.take(lowest)
            lower = False
            while (start < end or late) and not lower:
                if late and (start == end or late[0] < positions[start]):
                    at = heappop(late)
                else:
                    at = positions[start]
                    start += 1
                if pair[at] != lowest:
                    continue  # stale
                gone = after[at]
                until = after[at] = after[gone]
                own[at], own[gone], pair[gone] = lowest, -1, -1
                new = -1
                if not first[until]:
                    before[until] = at
                    new = joins.get(lowest << shift | own[until], -1)
                pair[at] = new
                left = before[at]
                for place in (at, left):
                    if place != at:
                        if left < 0:
                            break
                        new = pair[left] = joins.get(own[left] << shift | lowest, -1)
                    if new < 0:
                        continue
                    if new < lowest:
                        lower = True
                    bucket = buckets.get(new)
                    if bucket is not None:
                        heappush(bucket, place)
                    else:
                        buckets[new] = [place]
                        if new not in early:
                            mark(new)
            queue.put_back(lowest, start, end, late)
        left_over = np.array(own, np.int32)
        alive = left_over >= 0
        cuts = np.concatenate([[0], np.cumsum(alive)])[borders].tolist()
        parts = left_over[alive].tolist()
        return parts, cuts

    def _learn(self, pieces: Iterable[str]) -> None:
        """Know all these pre-tokens."""
        if self.held > KNOWN_BYTES:
            self._forget()
        new = [(piece, piece.encode()) for piece in set(pieces).difference(self.told)]
        parted = [(piece, data) for piece, data in new if data not in self.ranks]
        for piece, data in new:
            rank = self.ranks.get(data)
            if rank is not None:
                self.told[piece], self.content[piece] = self.names[rank], self.tokens[rank]
            self.held += len(data) + PIECE_BYTES
        if parted:
            parts, cuts = self.merged([data for _, data in parted])
            names = list(map(self.names.__getitem__, parts))
            tokens = list(map(self.tokens.__getitem__, parts))
            for (piece, _), a, b in zip(parted, cuts, cuts[1:]):
                self.told[piece], self.content[piece] = ",".join(names[a:b]), b"".join(tokens[a:b])

    def _known_blocks(self, texts: Iterable[str]) -> Iterator[tuple[int, list[str]]]:
        """Pre-tokens of texts as (number of the text, next ones of it), in order, once they are
        known. A text may come in several parts, and one without any in none."""
        held: list[tuple[int, list[str]]] = []
        count = 0
        for number, text in enumerate(texts):
            for block in self.pieces(text):
                held.append((number, block))
                count += len(block)
                if count >= PIECES_AT_ONCE:
                    self._learn(chain.from_iterable(block for _, block in held))
                    yield from held
                    held, count = [], 0
        self._learn(chain.from_iterable(block for _, block in held))
        yield from held

    def encoded(self, texts: Iterable[str]) -> Iterator[tuple[int, list[int]]]:
        """Token ids of texts as (number of the text, next ids of it)."""
        for number, block in self._known_blocks(texts):
            told = ",".join(map(self.told.__getitem__, block))
            yield number, list(map(int, told.split(","))) if told else []

    def round_trips(self, texts: Iterable[str]) -> Iterator[tuple[int, str, bytes]]:
        """As ``encoded``; the ids in decimal with commas between, and the bytes they stand for."""
        for number, block in self._known_blocks(texts):
            if block:
                told = ",".join(map(self.told.__getitem__, block))
                yield number, told, b"".join(map(self.content.__getitem__, block))

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _unknown_to(pattern_class: str) -> np.ndarray:
    """For each code point whether the pattern's module has it in a class and the library has not."""
    singles = {bytes([i]): i for i in range(256)}
    theirs = tiktoken.Encoding(
        "class", pat_str=pattern_class, mergeable_ranks=singles, special_tokens={}
    )
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    every = "".join(map(chr, points))
    known = bytes(theirs.encode_ordinary(every)).decode()
    both = np.zeros(0x110000, np.int8)
    both[[ord(c) for c in regex.findall(pattern_class, every)]] += 1
    both[[ord(c) for c in known]] -= 1
    if (both < 0).any():
        raise ValueError(f"the pattern's module knows fewer characters of {pattern_class}")
    return both > 0


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a file of ranks (a token in base 64 and its rank on each line).

    Every single byte has to be a token. The file is read on the driver and bounded by
    ``VOCABULARY_BYTES``.
    """
    with open(path, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"{path!r} is larger than a vocabulary may be")
    lines = (line.split() for line in content.splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    missing = [i for i in range(256) if bytes([i]) not in ranks]
    if missing:
        raise ValueError(f"{path!r} has no token for the bytes {missing[:5]}")
    return Vocabulary(ranks, pattern, _unknown_to(r"\p{L}") | _unknown_to(r"\p{N}"))


def _as_text(data: bytes | None) -> str:
    return (data or b"").decode("utf-8", "replace")


def token_digests(
    docs: DataFrame, vocabulary: Vocabulary, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each text encoded and decoded again: id, n_tokens, and SHA-256 of ids and of decoded bytes.

    Ids are told in decimal with commas between. A null text counts as empty; bytes that
    are no UTF-8 count as the replacement character, as a string cannot hold them. A text is worked
    off in blocks of pre-tokens, so its tokens are never held all at once; repeated rows give equal
    rows, an empty table an empty result. Other columns are not looked at.
    """
    kinds = T.StructType([T.StructField("id", docs.schema[doc_id].dataType)])
    kinds = kinds.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    shared = Kept(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, words = to_arrow_schema(kinds), shared.value
        for ids, texts in blocks(batches):
            counts = [0] * len(ids)
            names, contents = ([hashlib.sha256() for _ in ids] for _ in range(2))
            for i, told, content in words.round_trips(map(_as_text, texts)):
                names[i].update(f",{told}".encode() if counts[i] else told.encode())
                counts[i] += told.count(",") + 1
                contents[i].update(content)
            hexes = ([h.hexdigest() for h in column_] for column_ in (names, contents))
            arrays = [pa.array(x, f.type) for x, f in zip((ids, counts, *hexes), schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return id_and_bytes(docs, doc_id, text).mapInArrow(run, kinds).withColumnRenamed("id", doc_id)


def _per_value(
    df: DataFrame, source: str, result: str, kind: T.DataType, function, vocabulary: Vocabulary
) -> DataFrame:
    """``df`` with a column of ``function(vocabulary, value)``, row by row, null for null."""
    name = fresh(df, result)
    kinds = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    shared = Kept(df.sparkSession, vocabulary)
    place = df.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, words = to_arrow_schema(kinds), shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                value = one.column(place)[0].as_py()
                found = None if value is None else function(words, value)
                added = pa.array([found], schema.field(len(schema) - 1).type)
                yield pa.RecordBatch.from_arrays([*one.columns, added], schema=schema)

    return df.select(*map(column, df.columns)).mapInArrow(run, kinds)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``tokens``, the ids of a text; null for null, an empty array for an empty text."""

    def ids(words: Vocabulary, value: str) -> np.ndarray:
        blocks_ = [np.array(block, np.int32) for _, block in words.encoded([value])]
        return np.concatenate([np.empty(0, np.int32), *blocks_])

    return _per_value(docs, text, "tokens", T.ArrayType(T.IntegerType()), ids, vocabulary)


def decode(docs: DataFrame, vocabulary: Vocabulary, tokens: str = "tokens") -> DataFrame:
    """``docs`` with ``decoded``, the bytes of an array of ids; null for null."""

    def content(words: Vocabulary, ids: list[int]) -> bytes:
        return words.decoded(ids)

    return _per_value(docs, tokens, "decoded", T.BinaryType(), content, vocabulary)
