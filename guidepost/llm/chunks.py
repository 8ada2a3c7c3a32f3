"""Substring deduplication by content-defined chunks.

A gear hash rolls over a text; where its bits fall into a pattern, a chunk ends. So
chunks follow the content, and an insertion only changes those around it. Chunks with the same
digest are the same; one of them stays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column
from guidepost.llm.batches import (
    Arrays,
    ints,
    map_rows,
    runs,
    sha,
    text_batches,
    unpacked,
)
from guidepost.llm.textops import numbers
from guidepost.sources.scratch import snapshot

GEAR = numbers(300, 256)
DOUBLINGS = 4  # the hash looks back 2**4 bytes
CUT_BITS = 4  # a place is a candidate if so many bits of the hash are zero
LEAST, MOST = 12, 256  # bytes of a chunk
DIGEST = 16
CHUNKS_PER_GROUP = 1 << 18


def gear(buf: np.ndarray) -> np.ndarray:
    """At each place the rolling hash of the last 16 bytes: for each byte the hash doubles and
    the byte's number is added. Doubled windows give it for all places at once."""
    total = GEAR[buf]
    for k in range(DOUBLINGS):
        width = 1 << k
        longer = total.copy()
        longer[width:] += total[: max(0, len(total) - width)] << np.uint64(width)
        total = longer
    return total


def chunk_ends(text: np.ndarray) -> np.ndarray:
    """Where the chunks of one text end. A candidate counts if none lies less than ``LEAST``
    bytes before it; gaps beyond ``MOST`` bytes are cut there."""
    # These bits have seen all 16 bytes.
    shift = np.uint64(16 - CUT_BITS)
    pattern = (gear(text) >> shift) & np.uint64((1 << CUT_BITS) - 1)
    at = np.flatnonzero(pattern == 0) + 1
    apart = np.concatenate([[True], np.diff(at) >= LEAST]) if len(at) else np.empty(0, bool)
    ends = np.union1d(at[apart], [len(text)]) if len(text) else np.empty(0, np.int64)
    gaps = np.diff(np.concatenate([[0], ends]))
    extra = (gaps - 1) // MOST
    if not extra.any():
        return ends
    first = np.repeat(ends - gaps, extra)
    number = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    return np.union1d(ends, first + number * MOST)


def _chunked(raw: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The chunks of joined texts: the text of each, where it ends, and its digest."""
    buf = np.frombuffer(raw, np.uint8)
    text, ends, digests = [], [], []
    digest = xxhash.xxh128_digest
    begin = 0
    for number, size in enumerate(sizes.tolist()):
        own = chunk_ends(buf[begin : begin + size]) + begin
        text.append(np.full(len(own), number))
        ends.append(own)
        places = own.tolist()
        digests += [digest(raw[a:b]) for a, b in zip([begin, *places], places)]
        begin += size
    none = np.empty(0, np.int64)
    return np.concatenate([none, *text]), np.concatenate([none, *ends]), digests


def _as_table(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _firsts(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by digest and then ``order``: the sorted numbers, which of them is the first
    of its digest, and how many rows have its digest."""
    by = np.lexsort((order, keys[:, 1], keys[:, 0]))
    ordered = keys[by]
    new = np.ones(len(by), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    group = np.cumsum(new) - 1
    return by, new, np.bincount(group)[group] if len(by) else group


def _dealt(batches: DataFrame, groups: int) -> DataFrame:
    """group, batch and for each distinct digest of the batch: the digest, the rank of the first
    text that has it, and whether the batch has it more than once."""

    def deal(row: dict) -> Arrays:
        raw, ranks = unpacked(row["blob"]), np.array(row["ranks"], np.int64)
        text, _, digests = _chunked(raw, ints(row["sizes"]))
        keys = _as_table(digests)
        by, new, count = _firsts(keys, ranks[text])
        kept = by[new]
        group = (keys[kept, 0] % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        used, first = np.unique(group[order], return_index=True)
        out: Arrays = {name: [] for name in kinds.names}
        for g, own in zip(used.tolist(), np.split(order, first[1:]) if len(used) else []):
            out["group"].append(g)
            out["batch"].append(row["batch"])
            out["digests"].append(keys[kept[own]].tobytes())
            out["ranks"].append(ranks[text[kept[own]]].astype("<i8").tobytes())
            out["many"].append((count[new][own] > 1).astype(np.uint8).tobytes())
        return out

    kinds = T.StructType.fromDDL("group long, batch long, digests binary, ranks binary, many binary")
    return map_rows(batches.select("batch", "ranks", "sizes", "blob"), kinds, deal)


def _judged(dealt: DataFrame) -> DataFrame:
    """For each batch its digests that occur more than once anywhere: batch, digests and whether
    the first of all occurrences is in this batch (``own``)."""

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, "<u8").reshape(-1, 2) for x in rows["digests"]]
        keys = np.concatenate(lists)
        ranks = np.concatenate([np.frombuffer(x, "<i8") for x in rows["ranks"]])
        many = np.frombuffer(b"".join(rows["many"]), np.uint8).astype(bool)
        batch = np.repeat(rows["batch"].to_numpy(np.int64), [len(x) for x in lists])
        # Equal ranks: the smaller batch is first.
        by_batch = np.argsort(batch, kind="stable")
        by, new, count = _firsts(keys[by_batch], ranks[by_batch])
        by = by_batch[by]
        first, often = np.zeros(len(by), bool), np.zeros(len(by), bool)
        first[by], often[by] = new, count > 1
        often |= many
        ends = np.cumsum([len(x) for x in lists])[:-1]
        found = [
            (int(b), k[o].tobytes(), f[o].astype(np.uint8).tobytes())
            for b, k, o, f in zip(
                rows["batch"], lists, np.split(often, ends), np.split(first, ends)
            )
            if o.any()
        ]
        return pd.DataFrame(found, columns=["batch", "digests", "own"])

    return dealt.groupBy("group").applyInPandas(find, "batch long, digests binary, own binary")


RESULT = (
    "n_bytes long, n_chunks long, n_repeated long, n_removed long, n_spans long, "
    "kept_sha256 string, kept binary"
)


def _cleaned(batches: DataFrame, judged: DataFrame, least_run: int) -> DataFrame:
    own_id = T.StructField("id", batches.schema["ids"].dataType.elementType)
    kinds = T.StructType([own_id, *T.StructType.fromDDL(RESULT).fields])

    def clean(row: dict) -> Arrays:
        raw, ranks = unpacked(row["blob"]), np.array(row["ranks"], np.int64)
        sizes = ints(row["sizes"])
        text, ends, digests = _chunked(raw, sizes)
        known: dict[bytes, bool] = {}
        for found in row["found"] or []:
            flags = found["own"]
            for i, own in enumerate(flags):
                known[found["digests"][i * DIGEST : (i + 1) * DIGEST]] = bool(own)
        repeated = np.array([d in known for d in digests], bool)
        stays = np.zeros(len(digests), bool)
        if repeated.any():
            by, new, _ = _firsts(_as_table(digests), ranks[text])
            leads = by[new]
            stays[leads] = [known.get(digests[i], True) for i in leads.tolist()]
        begin_of = np.concatenate([[0], ends[:-1]])
        text_begin = np.cumsum(sizes) - sizes
        out: Arrays = {name: [] for name in kinds.names}
        lo, hi = np.searchsorted(text, [np.arange(len(sizes)), np.arange(len(sizes)) + 1])
        buf = np.frombuffer(raw, np.uint8)
        for i, key in enumerate(row["ids"]):
            a, b = int(lo[i]), int(hi[i])
            start = int(text_begin[i])
            mask = np.zeros(int(sizes[i]), bool)
            for s, e in zip(*runs(repeated[a:b] & ~stays[a:b])):
                from_, to = int(begin_of[a + s]), int(ends[a + e - 1])
                if to - from_ >= least_run:
                    mask[from_ - start : to - start] = True
            kept = buf[start : start + int(sizes[i])][~mask].tobytes()
            out["id"].append(key)
            out["n_bytes"].append(int(sizes[i]))
            out["n_chunks"].append(b - a)
            out["n_repeated"].append(int(repeated[a:b].sum()))
            out["n_removed"].append(int(mask.sum()))
            out["n_spans"].append(len(runs(mask)[0]))
            out["kept_sha256"].append(sha(kept))
            out["kept"].append(kept)
        return out

    pairs = F.collect_list(F.struct("digests", "own")).alias("found")
    found = judged.groupBy("batch").agg(pairs)
    return map_rows(batches.drop("n_bytes").join(found, "batch", "left"), kinds, clean)


def without_repeated_chunks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_run: int = 0
) -> DataFrame:
    """id, n_bytes, n_chunks, n_repeated (chunks that occur elsewhere, too), n_removed (bytes),
    n_spans, kept_sha256 and kept (the bytes that are left) of each row.

    Of equal chunks the one in the row with the smallest id stays, within a row the first; rows
    with equal ids, and those with ids that are not whole numbers, are in the order of a hash of
    the row; null ids come last. Repeated chunks are removed where neighbours make up at least ``least_run``
    bytes, by default always. A null text counts as empty; an exact copy of a row keeps
    nothing then. Other columns are not looked at; an empty table stays empty.
    """
    whole = isinstance(docs.schema[doc_id].dataType, T.IntegralType)
    own = column(doc_id).cast("long") if whole else F.xxhash64(column(doc_id), column(text))
    last = F.lit((1 << 63) - 1)
    rank = F.when(column(doc_id).isNull(), last).otherwise(own)
    ranked = docs.select(F.struct(column(doc_id).alias("id"), rank.alias("rank")).alias("id"),
                         column(text).alias("text"))
    packed_rows = snapshot(text_batches(ranked, "id", "text"), "chunk-batches")
    batches = packed_rows.select(
        "batch",
        F.transform("ids", lambda x: x["id"]).alias("ids"),
        F.transform("ids", lambda x: x["rank"]).alias("ranks"),
        "sizes",
        "n_bytes",
        "blob",
    )
    total = packed_rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    groups = max(8, int(total // 32 // CHUNKS_PER_GROUP))
    cleaned = _cleaned(batches, _judged(_dealt(batches, groups)), least_run)
    return cleaned.withColumnRenamed("id", doc_id)
