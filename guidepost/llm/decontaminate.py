"""Benchmark decontamination by greedy string tiling.

A text and a benchmark item that share a run of five tokens are tiled: the longest runs that
both have are marked one after the other, without overlap, and the share of the item's tokens
that end up under tiles decides. Passages are found in any order and with changes in between.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column
from guidepost.llm.frames import Shared, fresh
from guidepost.sources.scratch import snapshot

TILE = 5  # tokens of the shortest tile; of a shorter item, all
PAIRS = 4  # pairs of seeds for each token of both texts that are looked at one by one
COVERAGE = 0.5
BLOCK_BYTES = 4 * 1024 * 1024  # benchmark text that tasks hold at a time

RADIX = np.uint64(0x9E3779B97F4A7C15)
_TOKENS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, in lower case."""
    return (text or "").lower().encode("utf-8", "replace").translate(_TOKENS).split()


def rolling(numbers: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` numbers."""
    count = max(0, len(numbers) - length + 1)
    total = np.zeros(count, np.uint64)
    for k in range(length):
        total = total * RADIX + numbers[k : k + count].astype(np.uint64)
    return total


@dataclass
class Seeds:
    """Runs of one length: their sorted hashes, and for each the items and positions they have."""

    hashes: np.ndarray
    places: dict[int, dict[int, list[int]]]


@dataclass
class Index:
    """Benchmark items as token numbers, and where their seeds occur. A seed has ``TILE`` tokens;
    a shorter item is its own seed."""

    names: list
    items: list[np.ndarray]
    vocabulary: dict[bytes, int]
    seeds: dict[int, Seeds]  # by length

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]]) -> Index:
        vocabulary: dict[bytes, int] = {}
        places: dict[int, dict[int, dict[int, list[int]]]] = {}
        items = []
        for number, (_, text) in enumerate(rows):
            own = [vocabulary.setdefault(t, len(vocabulary) + 1) for t in tokens(text)]
            items.append(np.array(own, np.int64))
            if own:
                length = min(TILE, len(own))
                of_length = places.setdefault(length, defaultdict(dict))
                for at, key in enumerate(rolling(items[-1], length).tolist()):
                    of_length[key].setdefault(number, []).append(at)
        seeds = {
            length: Seeds(np.array(sorted(own), np.uint64), dict(own))
            for length, own in places.items()
        }
        return cls([name for name, _ in rows], items, vocabulary, seeds)


def common_runs(
    item: np.ndarray, doc: np.ndarray, hits: list[tuple[int, list[int]]]
) -> Iterator[tuple[int, int, int]]:
    """Maximal runs (position in item, position in doc, length) that the seeds lie on.

    ``hits`` has, in order, positions in the document and those in the item with the same seed. Where a
    repeated token makes more pairs of them than the texts have tokens, whole diagonals are
    compared instead, so that pairs are never listed.
    """
    least = min(TILE, len(item))
    if sum(len(own) for _, own in hits) > PAIRS * (len(item) + len(doc)):
        yield from _runs_by_diagonal(item, doc, hits[0][0], hits[-1][0] + least, least)
        return
    ends: dict[int, int] = {}  # of the last run on each diagonal, in the document
    for t, own in hits:
        for p in own:
            if t + least <= ends.get(t - p, 0):
                continue
            if (item[p : p + least] != doc[t : t + least]).any():
                continue
            most = min(len(item) - p, len(doc) - t)
            unlike = np.flatnonzero(item[p : p + most] != doc[t : t + most])
            length = int(unlike[0]) if len(unlike) else most
            ends[t - p] = t + length
            yield p, t, length


def _runs_by_diagonal(
    item: np.ndarray, doc: np.ndarray, begin: int, end: int, least: int
) -> Iterator[tuple[int, int, int]]:
    """The same runs, all of which lie in ``doc[begin:end]``."""
    for shift in range(begin - len(item) + least, end - least + 1):
        p = max(0, begin - shift)
        size = min(len(item) - p, end - shift - p)
        same = item[p : p + size] == doc[p + shift : p + shift + size]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                yield p + a, p + shift + a, b - a


def tiled(item: np.ndarray, doc: np.ndarray, hits: list[tuple[int, list[int]]]) -> int:
    """Tokens of the item under tiles: the longest run of unmarked tokens is marked first, of
    equal ones the first in the item, then the first in the document."""
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    least = min(TILE, len(item))
    queue = [(-length, p, t) for p, t, length in common_runs(item, doc, hits)]
    heapq.heapify(queue)
    while queue:
        negative, p, t = heapq.heappop(queue)
        length = -negative
        free = free_item[p : p + length] & free_doc[t : t + length]
        if free.all():
            free_item[p : p + length] = False
            free_doc[t : t + length] = False
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]])))
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(queue, (a - b, p + a, t + a))
    return int((~free_item).sum())


def coverages(index: Index, text: str | None) -> dict[int, float]:
    """The covered share of each item that has a seed in common with a text."""
    known = index.vocabulary.get
    words = tokens(text)
    doc = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
    missing = np.concatenate([[0], np.cumsum(doc == 0)])
    hits: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for length, seeds in index.seeds.items():
        if len(doc) < length:
            continue
        at = np.flatnonzero(missing[length:] == missing[:-length])
        keys = rolling(doc, length)[at]
        near = np.minimum(np.searchsorted(seeds.hashes, keys), len(seeds.hashes) - 1)
        found = seeds.hashes[near] == keys
        for t, key in zip(at[found].tolist(), keys[found].tolist()):
            for number, own in seeds.places[key].items():
                hits[number].append((t, own))
    return {n: tiled(index.items[n], doc, own) / len(index.items[n]) for n, own in hits.items()}


def _index_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[Index]:
    """The benchmark in blocks of about ``BLOCK_BYTES``; a row's block is a hash of its columns."""
    rows = benchmark.select(column(item_id).alias("item"), column(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("bytes"))
    count = max(1, -(-size.first()["bytes"] // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for number in range(count):
        own = rows.where(block == number).distinct().orderBy("item", "text").collect()
        yield Index.of([(row["item"], row["text"]) for row in own])


def _finder(held: Shared, coverage: float, kind: T.StructType) -> Callable[[Column], Column]:
    def find(texts: pd.Series) -> pd.DataFrame:
        own = held.value
        rows = []
        for value in texts:
            found = coverages(own, value)
            over = sorted(n for n, share in found.items() if share >= coverage)
            rows.append((max(found.values(), default=0.0), [own.names[n] for n in over]))
        return pd.DataFrame(rows, columns=["largest", "items"])

    return F.pandas_udf(find, kind)


def with_coverage(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str,
    result: str,
    item_id: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """``docs`` with a column ``result``: the largest covered share of an item, and the items
    of which at least ``coverage`` is covered.

    Texts are held against the benchmark block by block; with several blocks, the table is
    stored after each, so that tasks hold one block at a time.
    """
    spark = docs.sparkSession
    item = T.ArrayType(benchmark.schema[item_id].dataType)
    kind = T.StructType([T.StructField("largest", T.DoubleType()), T.StructField("items", item)])
    known = docs.columns
    for number, index in enumerate(_index_blocks(benchmark, item_id, item_text)):
        if number:
            docs = snapshot(docs, "decontaminate")
        new = _finder(Shared(spark, index), coverage, kind)(column(text))
        if number:
            found = fresh(docs, "found")
            docs = docs.withColumn(found, new)
            new = F.struct(
                F.greatest(f"{result}.largest", f"{found}.largest").alias("largest"),
                F.concat(f"{result}.items", f"{found}.items").alias("items"),
            )
        docs = docs.withColumn(result, new).select(*[column(c) for c in known], column(result))
    return docs


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """id, contaminated, n_items, coverage and items of each row.

    ``coverage`` is the largest covered share of any item, ``items`` are those covered enough
    (ordered within a benchmark block). A null or empty text covers nothing; an item of fewer
    than five tokens is covered as a whole or not at all, one without tokens never; equal benchmark rows count once; repeated documents are
    treated alike; an empty benchmark leaves all clean. Other columns are not looked at.
    """
    rows = docs.select(column(doc_id).alias("id"), column(text).alias("text"))
    found = with_coverage(rows, benchmark, "text", "found", **options)
    return found.select(
        F.col("id").alias(doc_id),
        (F.size("found.items") > 0).alias("contaminated"),
        F.size("found.items").cast("long").alias("n_items"),
        F.col("found.largest").alias("coverage"),
        F.col("found.items").alias("items"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item enough, in their own columns.

    Rules and edge cases are those of ``contamination``: rows with a null or empty text stay, repeated
    rows stay or go together, and an empty benchmark or table changes nothing.
    """
    result = fresh(docs, "contamination")
    found = with_coverage(docs, benchmark, text, result, **options)
    clean = found.where(F.size(F.col(f"{result}.items")) == 0)
    return clean.select(*[column(c) for c in docs.columns])
