"""Removal of repeated substrings by a distributed difference-cover algorithm.

1. Texts are packed into batches, and these are stored.
2. The tuples at sampled places are named, dealt out by name and sorted; a name that occurs once
   cannot be part of a repeated string. Batches get back the names that occur again.
3. Suffixes that have such a place ahead of them are merged with all others they could equal:
   they are cut into pieces by their least seed and dealt out by it, a piece once for a batch.
4. Each group sorts its suffixes and compares neighbours on their first 400 bytes. Suffixes of a
   seed that too many share (the ends of a passage that stands in many texts) are dealt out one by
   one instead, by the name of their 400 bytes, once for a batch.
5. Batches get back the repeated strings and cut them out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.llm.batches import (
    Arrays,
    as_ints,
    ints,
    map_rows,
    packed,
    runs,
    sha,
    text_batches,
    unpacked,
)
from guidepost.llm.frames import Shared
from guidepost.llm.suffixes import (
    MATCH,
    pieces,
    repeated_windows,
    sampled,
    tuple_names,
    window_names,
    windows_near,
)
from guidepost.sources.scratch import snapshot

NAMES_PER_GROUP = 1 << 18
PIECES_BYTES_PER_GROUP = 4 * 1024 * 1024
HEAVY_BYTES = 32 * 1024 * 1024  # of a seed's pieces, beyond which they are dealt out one by one
NAME_BITS = 32  # bits of a name besides those of its group's number

def _names(sizes: np.ndarray, buf: np.ndarray, group_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sampled places of a batch and their names, shortened to the bits in use."""
    places = sampled(sizes)
    names = tuple_names(buf, places) >> np.uint64(64 - NAME_BITS - group_bits)
    return places, names


def _dealt_names(batches: DataFrame, group_bits: int) -> DataFrame:
    """group, batch and the names (their last 32 bits, sorted, once each) of each batch."""

    def deal(row: dict) -> Arrays:
        buf = np.frombuffer(unpacked(row["blob"]), np.uint8)
        names = np.unique(_names(ints(row["sizes"]), buf, group_bits)[1])
        group = (names >> np.uint64(NAME_BITS)).astype(np.int64)
        used, first = np.unique(group, return_index=True)
        parts = np.split(names.astype(np.uint32), first[1:]) if len(used) else []
        return {
            "group": used.tolist(),
            "batch": [row["batch"]] * len(used),
            "names": [p.tobytes() for p in parts],
        }

    kinds = T.StructType.fromDDL("group long, batch long, names binary")
    return map_rows(batches.select("batch", "sizes", "blob"), kinds, deal)


def _recurring(dealt: DataFrame) -> DataFrame:
    """For each batch the names that other batches have, too: batch, group, names."""

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, np.uint32) for x in rows["names"]]
        names = np.concatenate(lists)
        order = np.argsort(names, kind="stable")
        same = names[order[1:]] == names[order[:-1]]
        twice = np.zeros(len(names), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        ends = np.cumsum([len(x) for x in lists])
        kept = [part[mask] for part, mask in zip(lists, np.split(twice, ends[:-1]))]
        found = [(b, g, k.tobytes()) for b, g, k in zip(rows["batch"], rows["group"], kept) if len(k)]
        return pd.DataFrame(found, columns=["batch", "group", "names"])

    return dealt.groupBy("group").applyInPandas(find, "batch long, group long, names binary")


def _marked(batches: DataFrame, recurring: DataFrame, group_bits: int) -> DataFrame:
    """Two kinds of rows. For a text without recurring names its result: id, n_bytes and
    kept_sha256. For each batch with other texts: batch, ids, sizes, blob, first and last (the
    runs of suffixes to look at, into the joined texts)."""
    ids = batches.schema["ids"].dataType
    kinds = T.StructType([T.StructField("id", ids.elementType)]).add("n_bytes", "long")
    kinds = kinds.add("kept_sha256", "string").add("batch", "long").add("ids", ids)
    for name in ("sizes", "blob", "first", "last"):
        kinds = kinds.add(name, "binary")

    def mark(row: dict) -> Arrays:
        raw = unpacked(row["blob"])
        sizes, buf = ints(row["sizes"]), np.frombuffer(raw, np.uint8)
        places, names = _names(sizes, buf, group_bits)
        order = np.argsort(names)
        again = np.zeros(len(names), bool)
        same = names[order[1:]] == names[order[:-1]]
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        if row["found"]:
            known = np.sort(np.concatenate([
                np.frombuffer(f["names"], np.uint32).astype(np.uint64)
                | (np.uint64(f["group"]) << np.uint64(NAME_BITS))
                for f in row["found"]
            ]))
            near = np.minimum(np.searchsorted(known, names), len(known) - 1)
            again |= known[near] == names
        first, last = windows_near(places[again], sizes)
        begins = np.cumsum(sizes) - sizes
        live = np.zeros(len(sizes), bool)
        text = np.searchsorted(begins + sizes, first, "right")
        live[text] = True
        shift = np.where(live, begins - np.cumsum(np.where(live, sizes, 0)) + sizes, 0)
        clean = np.flatnonzero(~live).tolist()
        out: Arrays = {name: [] for name in kinds.names}
        for i in clean:
            own = raw[begins[i] : begins[i] + sizes[i]]
            out["id"].append(row["ids"][i])
            out["n_bytes"].append(len(own))
            out["kept_sha256"].append(sha(own))
        rest = np.flatnonzero(live).tolist()
        if rest:
            out["id"].append(None)
            out["n_bytes"].append(None)
            out["kept_sha256"].append(None)
        blank = [None] * len(clean)
        values = {
            "batch": row["batch"],
            "ids": [row["ids"][i] for i in rest],
            "sizes": as_ints(sizes[rest]),
            "blob": packed(b"".join(raw[begins[i] : begins[i] + sizes[i]] for i in rest)),
            "first": as_ints(first - shift[text]),
            "last": as_ints(last - shift[text]),
        }
        for name, value in values.items():
            out[name] = blank + ([value] if rest else [])
        return out

    found = recurring.groupBy("batch").agg(F.collect_list(F.struct("group", "names")).alias("found"))
    joined = batches.join(found, "batch", "left").select("batch", "ids", "sizes", "blob", "found")
    return map_rows(joined, kinds, mark)


@dataclass
class Cut:
    """A batch's joined texts and its pieces: first and last start, key, for each piece the
    first of the batch with the same bytes, and how often these occur."""

    buf: np.ndarray
    first: np.ndarray
    last: np.ndarray
    key: np.ndarray
    leader: np.ndarray
    times: np.ndarray

    def texts(self, numbers: np.ndarray) -> list[bytes]:
        return [self.buf[self.first[i] : self.last[i] + MATCH].tobytes() for i in numbers]

    def starts(self, numbers: np.ndarray) -> np.ndarray:
        """All starts of strings in the pieces."""
        count = self.last[numbers] - self.first[numbers] + 1
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(self.first[numbers], count) + within


def _cut(row: dict) -> Cut:
    buf = np.frombuffer(unpacked(row["blob"]), np.uint8)
    found = list(pieces(buf, ints(row["first"]), ints(row["last"])))
    none = np.empty(0, np.int64)
    first = np.concatenate([none, *(starts for _, _, starts, _ in found)])
    last = np.concatenate([none, *(np.append(starts[1:] - 1, b) for _, b, starts, _ in found)])
    key = np.concatenate([none.astype(np.uint64), *(keys for _, _, _, keys in found)])
    seen: dict[bytes, int] = {}
    raw = buf.tobytes()
    leader = np.array(
        [seen.setdefault(raw[a : b + MATCH], i) for i, (a, b) in enumerate(zip(first, last))],
        np.int64,
    )
    return Cut(buf, first, last, key, leader, np.bincount(leader, minlength=len(leader)))


def _live(marked: DataFrame) -> DataFrame:
    rows = marked.where(F.col("blob").isNotNull())
    return rows.select("batch", "ids", "sizes", "blob", "first", "last")


def _heavy_keys(marked: DataFrame) -> np.ndarray:
    """Seeds whose pieces, once for each batch, have over ``HEAVY_BYTES``. There is at most one
    for each so many bytes of input."""

    def weigh(row: dict) -> Arrays:
        cut = _cut(row)
        lead = np.flatnonzero(cut.times)
        keys, at = np.unique(cut.key[lead], return_inverse=True)
        sizes = np.bincount(at, cut.last[lead] - cut.first[lead] + MATCH, len(keys))
        return {"key": keys.view(np.int64).tolist(), "bytes": sizes.astype(np.int64).tolist()}

    weighed = map_rows(_live(marked), T.StructType.fromDDL("key long, bytes long"), weigh)
    sums = weighed.groupBy("key").agg(F.sum("bytes").alias("bytes"))
    rows = sums.where(F.col("bytes") > HEAVY_BYTES).collect()
    return np.array(sorted(row["key"] for row in rows), np.int64).view(np.uint64)


def _by_group(group: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each group's number and the places at which it stands."""
    order = np.argsort(group, kind="stable")
    used, first = np.unique(group[order], return_index=True)
    return list(zip(used.tolist(), np.split(order, first[1:]))) if len(used) else []


def _dealt_pieces(marked: DataFrame, groups: int, heavy: Shared) -> DataFrame:
    """group, batch and the batch's pieces of that group: numbers, sizes, whether the batch has
    more than one (``many``), and their bytes."""
    kinds = T.StructType.fromDDL(
        "group long, batch long, numbers binary, sizes binary, many binary, blob binary"
    )

    def deal(row: dict) -> Arrays:
        cut = _cut(row)
        kept = np.flatnonzero((cut.times > 0) & ~np.isin(cut.key, heavy.value))
        out: Arrays = {name: [] for name in kinds.names}
        for group, at in _by_group((cut.key[kept] % np.uint64(groups)).astype(np.int64)):
            texts = cut.texts(kept[at])
            out["group"].append(group)
            out["batch"].append(row["batch"])
            out["numbers"].append(as_ints(kept[at]))
            out["sizes"].append(as_ints([len(t) for t in texts]))
            out["many"].append((cut.times[kept[at]] > 1).astype(np.uint8).tobytes())
            out["blob"].append(packed(b"".join(texts)))
        return out

    return map_rows(_live(marked), kinds, deal)


def _heavy_strings(cut: Cut, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the strings in heavy pieces, the distinct names of these strings in order, and
    for each start the number of its name."""
    starts = cut.starts(np.flatnonzero(np.isin(cut.key, heavy)))
    names, at = np.unique(window_names(cut.buf, starts), axis=0, return_inverse=True)
    return starts, names, at.reshape(-1)


def _dealt_strings(marked: DataFrame, groups: int, heavy: Shared) -> DataFrame:
    """group, batch, and the numbers and names of the batch's heavy strings of that group."""
    kinds = T.StructType.fromDDL("group long, batch long, numbers binary, names binary")

    def deal(row: dict) -> Arrays:
        _, names, _ = _heavy_strings(_cut(row), heavy.value)
        out: Arrays = {name: [] for name in kinds.names}
        for group, at in _by_group((names[:, 0] % np.uint64(groups)).astype(np.int64)):
            out["group"].append(group)
            out["batch"].append(row["batch"])
            out["numbers"].append(as_ints(at))
            out["names"].append(names[at].tobytes())
        return out

    return map_rows(_live(marked), kinds, deal)


def _recurring_strings(dealt: DataFrame) -> DataFrame:
    """For each batch the numbers of heavy strings that another batch has, too."""

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in rows["names"]]
        _, at, count = np.unique(
            np.concatenate(lists), axis=0, return_inverse=True, return_counts=True
        )
        ends = np.cumsum([len(x) for x in lists])[:-1]
        twice = np.split(count[at.reshape(-1)] > 1, ends)
        found = [
            (int(batch), as_ints(ints(numbers)[own]))
            for batch, numbers, own in zip(rows["batch"], rows["numbers"], twice)
            if own.any()
        ]
        return pd.DataFrame(found, columns=["batch", "strings"])

    return dealt.groupBy("group").applyInPandas(find, "batch long, strings binary")


def _compared(dealt: DataFrame) -> DataFrame:
    """For each batch the repeated strings among its single pieces: batch and runs, triples of
    piece, first and last start within it."""

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        buf = np.frombuffer(b"".join(map(unpacked, rows["blob"])), np.uint8)
        lists = [ints(x) for x in rows["sizes"]]
        sizes = np.concatenate(lists)
        many = np.frombuffer(b"".join(rows["many"]), np.uint8).astype(bool)
        numbers = np.concatenate([ints(x) for x in rows["numbers"]])
        begins = np.cumsum(sizes) - sizes
        count = sizes - MATCH + 1
        piece = np.repeat(np.arange(len(sizes)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        twice = repeated_windows(buf, begins[piece] + within) & ~many[piece]
        a, b = runs(twice)
        # A run may go on from one piece into the next.
        cuts = np.cumsum(count)[:-1]
        inner = cuts[twice[cuts - 1] & twice[cuts]] if len(cuts) else cuts
        a, b = np.sort(np.concatenate([a, inner])), np.sort(np.concatenate([b, inner]))
        triples = np.stack([numbers[piece[a]], within[a], within[b - 1]], axis=1)
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in lists])[piece[a]]
        batch = rows["batch"].to_numpy()
        found = [(int(batch[i]), as_ints(triples[owner == i])) for i in np.unique(owner)]
        return pd.DataFrame(found, columns=["batch", "runs"])

    return dealt.groupBy("group").applyInPandas(find, "batch long, runs binary")


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary"


def _removed(marked: DataFrame, compared: DataFrame, heavy: Shared) -> DataFrame:
    """Results of the texts of the marked batches."""
    own_id = T.StructField("id", marked.schema["id"].dataType)
    kinds = T.StructType([own_id, *T.StructType.fromDDL(RESULT).fields])

    def remove(row: dict) -> Arrays:
        cut = _cut(row)
        buf, sizes = cut.buf, ints(row["sizes"])
        change = np.zeros(len(buf) + 1, np.int32)
        many = cut.times[cut.leader] > 1
        np.add.at(change, cut.first[many], 1)
        np.add.at(change, cut.last[many] + MATCH, -1)
        if len(heavy.value):
            starts, names, at = _heavy_strings(cut, heavy.value)
            again = np.bincount(at, minlength=len(names)) > 1
            for numbers in row["strings"] or []:
                again[ints(numbers)] = True
            np.add.at(change, starts[again[at]], 1)
            np.add.at(change, starts[again[at]] + MATCH, -1)
        for triples in row["runs"] or []:
            piece, lo, hi = ints(triples).reshape(-1, 3).T
            np.add.at(change, cut.first[piece] + lo, 1)
            np.add.at(change, cut.first[piece] + hi + MATCH, -1)
        gone = np.cumsum(change[:-1]) > 0
        out: Arrays = {name: [] for name in kinds.names}
        begin = 0
        for key, size in zip(row["ids"], sizes.tolist()):
            mask = gone[begin : begin + size]
            a, b = runs(mask)
            out["id"].append(key)
            out["n_bytes"].append(size)
            out["n_removed"].append(int(mask.sum()))
            out["n_spans"].append(len(a))
            out["kept_sha256"].append(sha(buf[begin : begin + size][~mask].tobytes()))
            out["spans"].append(np.stack([a, b], axis=1).astype("<i8").tobytes())
            begin += size
        return out

    repeats = compared.groupBy("batch").agg(
        F.collect_list("runs").alias("runs"), F.collect_list("strings").alias("strings")
    )
    return map_rows(_live(marked).join(repeats, "batch", "left"), kinds, remove)


def repeated_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 and spans of each row.

    Removed is each byte of a text, as UTF-8, that is covered by a string of 400 bytes that also
    starts anywhere else, in the same text included; overlaps count, and strings are judged on
    the input. ``spans`` holds the maximal removed runs as pairs of little-endian 64-bit offsets
    (null for none). A null text counts as empty; texts below 400 bytes stay whole; a row and its
    exact copy remove each other where long enough; ids may repeat or be null; other columns are not
    looked at; an empty table stays empty. Memory of a task follows the longest text.
    """
    batches = snapshot(text_batches(docs, doc_id, text), "suffix-batches")
    total = batches.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n")).first()["n"]
    names = total // 11  # 12 of 133 places are sampled
    group_bits = max(4, int(names // NAMES_PER_GROUP).bit_length())
    recurring = _recurring(_dealt_names(batches, group_bits))
    marked = snapshot(_marked(batches, recurring, group_bits), "suffix-marked")
    long_ = F.coalesce(F.sum(F.length("blob")), F.lit(0))
    groups = max(8, int(4 * marked.agg(long_.alias("n")).first()["n"] // PIECES_BYTES_PER_GROUP))
    keys = _heavy_keys(marked)
    heavy = Shared(docs.sparkSession, keys)
    compared = _compared(_dealt_pieces(marked, groups, heavy))
    if len(keys):
        strings = _recurring_strings(_dealt_strings(marked, groups, heavy))
        compared = compared.unionByName(strings, allowMissingColumns=True)
    else:
        compared = compared.withColumn("strings", F.lit(None).cast("binary"))
    cut = _removed(marked, compared, heavy)
    whole = marked.where(F.col("blob").isNull()).select(
        "id",
        "n_bytes",
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        "kept_sha256",
        F.lit(None).cast("binary").alias("spans"),
    )
    return cut.union(whole).withColumnRenamed("id", doc_id)
