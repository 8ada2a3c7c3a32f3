"""SimHash fingerprints, and exact links between those that differ in few bits.

Fingerprints are dealt to shards by a vantage-point tree that is built on a bounded sample;
points near a boundary also visit the shards across it. Each shard builds a tree of its own and
gives back a spanning forest of its links, never the links of a dense group one by one. The
forests together have the components of all links.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column
from guidepost.llm.components import Forest, components
from guidepost.llm.frames import Shared, per_row
from guidepost.llm.vantage import build, pairs_within, route
from guidepost.sources.scratch import snapshot

SEED = 42
# Points that a shard should have at home. Points near a boundary are copied, and in 64 dimensions most
# points are near one: the copies of a point grow as the number of shards to the power of a third.
SHARD_POINTS = 131072
SAMPLE_PER_SHARD = 32
MAX_SHARDS = 65536  # the tree that all tasks get has no more leaves
LEAF_POINTS = 256


def shingles(text: bytes | None, length: int) -> list[bytes]:
    """Runs of ``length`` words in lower case (A-Z), repeats included; all words if fewer."""
    words = (text or b"").lower().split()
    if not words:
        return []
    if len(words) <= length:
        return [b" ".join(words)]
    ends = list(accumulate(len(w) + 1 for w in words))
    line = b" ".join(words)
    starts = [0, *ends]
    return [line[a : b - 1] for a, b in zip(starts, ends[length - 1 :])]


def fingerprint(text: bytes | None, length: int = 3) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64; without words, zero."""
    pieces = shingles(text, length)
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(p, SEED) for p in pieces), np.uint64, len(pieces))
    votes = np.zeros(64, np.int64)
    for i in range(0, len(values), 65536):
        octets = values[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(values), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _shard_edges(points: np.ndarray, guest: np.ndarray, reach: int) -> pd.DataFrame:
    """A spanning forest of the links of one shard, as pairs of fingerprints."""
    forest = Forest(len(points))
    tree, _ = build(points[~guest], LEAF_POINTS, reach)
    for _, at, visits in route(tree, points, guest, reach):
        for a, b in pairs_within(points[at], visits, reach):
            forest.link(at[a], at[b])
    child = np.flatnonzero(forest.parent != np.arange(len(points)))
    a, b = _signed(points[child]), _signed(points[forest.parent[child]])
    return pd.DataFrame({"high": np.maximum(a, b), "low": np.minimum(a, b)})


def links(points: DataFrame, reach: int) -> DataFrame:
    """Edges (high, low) whose components are those of all links between distinct ``point``s."""
    spark = points.sparkSession
    count = points.count()
    shards = min(MAX_SHARDS, -(-count // SHARD_POINTS))
    share = min(1.0, SAMPLE_PER_SHARD * shards / max(1, count))
    chosen = F.pmod(F.xxhash64("point"), F.lit(1 << 20)) < share * (1 << 20)
    rows = points.where(chosen).select("point").toPandas()
    sample = np.sort(rows["point"].to_numpy(np.int64)).view(np.uint64)
    sample = np.random.default_rng(1).permutation(sample)
    tree, _ = build(sample, SAMPLE_PER_SHARD, reach)
    held = Shared(spark, tree)

    def deal(batches):
        for batch in batches:
            own = batch["point"].to_numpy(np.int64).view(np.uint64)
            for shard, at, guest in route(held.value, own, np.zeros(len(own), bool), reach):
                yield pd.DataFrame({"shard": shard, "point": _signed(own[at]), "guest": guest})

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("point")
        own = rows["point"].to_numpy(np.int64).view(np.uint64)
        return _shard_edges(own, rows["guest"].to_numpy(bool), reach)

    dealt = points.select("point").mapInPandas(deal, "shard int, point long, guest boolean")
    return dealt.groupBy("shard").applyInPandas(link, "high long, low long")


def _fingerprints(rows: DataFrame, text: str, length: int) -> DataFrame:
    """id and point for each row; ``rows`` has an id column and the text."""
    kinds = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType), T.StructField("point", T.LongType())]
    )

    def run(ids: list, texts: list[bytes | None]) -> dict[str, list]:
        found = np.array([fingerprint(t, length) for t in texts], np.uint64)
        return {"id": ids, "point": _signed(found)}

    return per_row(rows.select("id", column(text).cast("binary").alias("text")), kinds, run)


def _grouped(marked: DataFrame, reach: int) -> DataFrame:
    """point and group of each distinct point of ``marked``; group is its component's root."""
    points = snapshot(marked.select("point").distinct(), "simhash-points")
    roots = components(links(points, reach))
    return points.join(roots, F.col("point") == F.col("node"), "left").select(
        "point", F.coalesce("root", "point").alias("group")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 3, reach: int = 2
) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of each row.

    Rows are linked if their fingerprints differ in at most ``reach`` bits; the component is
    named by its smallest id. A null or blank text has fingerprint zero and is linked like any
    other; a null id names nothing (null if all ids of the component are null). Repeated rows
    are rows like any other. An empty table gives an empty result; other columns are not looked at.
    """
    rows = docs.select(column(doc_id).alias("id"), column(text))
    marked = snapshot(_fingerprints(rows, text, length), "simhash-rows")
    groups = snapshot(_grouped(marked, reach), "simhash-groups")
    smallest = marked.groupBy("point").agg(F.min("id").alias("smallest"))
    named = snapshot(
        smallest.join(groups, "point").groupBy("group").agg(F.min("smallest").alias("component_id")),
        "simhash-names",
    )
    by_point = snapshot(groups.join(named, "group").select("point", "component_id"), "simhash-ids")
    return marked.join(by_point, "point").select(
        F.col("id").alias(doc_id), _hex("point").alias("fingerprint"), "component_id"
    )


def _hex(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 3, reach: int = 2
) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``.

    The row with the smallest id stays (a null id is the largest), of several such rows the one
    whose columns hash lowest. Equal rows are one row.
    """
    id_ = column(doc_id)
    content = F.xxhash64(*[column(c) for c in docs.columns])
    key = F.struct(id_.isNull().alias("no"), id_.alias("id"), content.alias("hash"))
    keyed = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
        key.alias("key"),
        content.alias("hash"),
        column(text).alias("text"),
    )
    rows = keyed.select(F.col("key").alias("id"), "text")
    marked = snapshot(_fingerprints(rows, "text", length), "simhash-rows")
    groups = snapshot(_grouped(marked, reach), "simhash-groups")
    first = marked.groupBy("point").agg(F.min("id").alias("first"))
    kept = first.join(groups, "point").groupBy("group").agg(F.min("first").alias("kept"))
    stays = snapshot(kept.select(F.col("kept.hash").alias("kept_hash"), "kept"), "simhash-kept")
    # Rows are shuffled by the hash alone, which also serves the last step; that the keys are equal
    # is said in two halves, as an equality would become one more key of the shuffle.
    same = F.col("key").between(F.col("kept"), F.col("kept"))
    found = keyed.drop("text").join(stays, (F.col("hash") == F.col("kept_hash")) & same)
    return found.dropDuplicates(["hash", "key"]).select("row.*")
