"""The trie of all beginnings of conversations, with totals over subtrees.

A node is a distinct sequence of first turns. It is named by its depth and 128 bits that every
turn adds to by XOR (a hash of the turn and its place), so names come from running sums that
can be cut anywhere. The smallest conversation through a node owns it: (owner, depth) is
unique.

Totals over subtrees are computed by time-forward processing. Nodes are sorted by reverse level
order, externally, by Spark; a task walks along and sends each node's totals to its parent
through a spilling priority queue, from which they come out when the parent's turn has come. A shard is a
subtree of bounded weight; what the shards' tops have is summed up by parent and goes into the
next round, whose shards are larger by the same factor and hold only what is left above, until
the root is done.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from guidepost.functions import column
from guidepost.llm.frames import word_count
from guidepost.llm.ordinals import ordinals
from guidepost.llm.spillqueue import MOST_IN_MEMORY, SpillingQueue
from guidepost.plans import apart, broadcast_if_small
from guidepost.sources.scratch import snapshot

# Conversations of so many neighbouring numbers share their first turns in the rebuilt table.
FAMILY = 20
MOST_SHARED = 3

# Turns of a conversation whose names one task sums up.
STRETCH = 1024
# A shard's weight, the turns that lie below its top in all conversations, is at most this.
SHARD_WEIGHT = 1 << 16

ENDS_BLOCK = 4096
NODE = ("depth", "a", "b")


def ordered_turns(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv, position (from 1), item, words and size (the conversation's turns).

    Turns stand in the order of ``turn``, null first, equal ones in that of their digests.
    ``item`` is a digest of role and text; null role or text is empty. Rows without a conversation
    belong to none and are left out.
    """
    said_by, said = (F.coalesce(column(c).cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(said_by).cast("string"), F.lit(":"), said_by, said)
    items = df.where(column(conv_id).isNotNull()).select(
        column(conv_id).cast("long").alias("conv"),
        column(turn).alias("turn"),
        F.unhex(F.sha2(told, 256)).alias("item"),
        word_count(said).alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("item")]
    # Stored, as sorting by range reads its input twice; that must not be the texts.
    placed = ordinals(snapshot(items, "trie-items"), "conv", order, "trie-turns")
    return placed.select("conv", (F.col("ordinal") + 1).alias("position"), "item", "words", "size")


def with_shared_beginnings(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth, item, words, length) and conversations (conv, length), rebuilt.

    Conversation c begins with the first h turns of conversation c - c % ``FAMILY`` (all if it
    has fewer, none if it is not there; the remainder is never negative) and goes on with its own after its first h; h is the
    checksum of c modulo 4. A conversation may end up without turns.
    """
    own = ordered.groupBy("conv", apart("conv")).agg(F.first("size").alias("size"))
    own = snapshot(own.drop("_apart"), "trie-conversations")
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_SHARED + 1)
    base = F.col("conv") - F.pmod("conv", F.lit(FAMILY))
    bases = own.select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    families = own.select("conv", "size", shared.alias("shared"), base.alias("base"))
    families = families.join(bases, "base", "left").withColumn(
        "taken", F.least("shared", F.coalesce("base_size", F.lit(0)))
    )
    length = F.col("taken") + F.greatest(F.col("size") - F.col("shared"), F.lit(0))
    families = snapshot(families.withColumn("length", length), "trie-families")
    first = ordered.where(F.col("position") <= MOST_SHARED).select(
        F.col("conv").alias("base"), F.col("position").alias("depth"), "item", "words"
    )
    begun = families.join(first, "base").where("depth <= taken")
    rest = ordered.drop("size").join(families, "conv").where("position > shared")
    rest = rest.withColumn("depth", F.expr("position - shared + taken"))
    names = ("conv", "depth", "item", "words", "length")
    turns = begun.select(*names).union(rest.select(*names))
    return turns, families.select("conv", "length")


def _named(turns: DataFrame) -> DataFrame:
    """``turns`` with the node they lead to (a, b), its parent (up_a, up_b) and a check.

    The running XOR is taken over stretches of a conversation, then over the sums of its
    stretches, so a long conversation is split over tasks.
    """
    own = turns.select(
        "conv",
        "depth",
        "words",
        "length",
        F.floor((F.col("depth") - 1) / STRETCH).alias("stretch"),
        F.xxhash64(F.lit(1), "depth", "item").alias("own_a"),
        F.xxhash64(F.lit(2), "depth", "item").alias("own_b"),
        F.xxhash64(F.lit(3), "item").alias("check"),
    )
    inside = Window.partitionBy("conv", "stretch").orderBy("depth")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv").orderBy("stretch")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy("conv", "stretch").agg(
        F.bit_xor("own_a").alias("own_a"), F.bit_xor("own_b").alias("own_b")
    )
    carried = sums.select(
        "conv",
        "stretch",
        *[F.coalesce(F.bit_xor(f"own_{x}").over(before), F.lit(0)).alias(f"old_{x}") for x in "ab"],
    )
    run = own.withColumns({x: F.bit_xor(f"own_{x}").over(upto) for x in "ab"})
    run = run.join(carried, ["conv", "stretch"])
    found = {x: F.col(x).bitwiseXOR(F.col(f"old_{x}")) for x in "ab"}
    ups = {f"up_{x}": F.col(x).bitwiseXOR(F.col(f"own_{x}")) for x in "ab"}
    run = run.withColumns(found).withColumns(ups)
    return run.select("conv", *NODE, "up_a", "up_b", "words", "length", "check")


def _nodes(paths: DataFrame) -> DataFrame:
    """Every node with its smallest conversation, its number of them, and its weight."""
    alike = [F.min(c).eqNullSafe(F.max(c)) for c in ("up_a", "up_b", "check", "words")]
    sure = alike[0] & alike[1] & alike[2] & alike[3]
    clash = F.raise_error(F.lit("two different beginnings have the same 128-bit name"))
    return paths.groupBy(*NODE).agg(
        F.when(sure, F.min("conv")).otherwise(clash).cast("long").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("up_a").alias("up_a"),
        F.min("up_b").alias("up_b"),
        F.min("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )


def _ends_digests(ends: DataFrame) -> DataFrame:
    """For each node of (depth, a, b, conv): SHA-256 of its conv numbers, ascending, with commas.

    Rows are sorted by range of node and conv, and a task joins neighbours to blocks of some
    kilobytes; a node's blocks then run through one digest, one after another.
    """
    blocks = T.StructType.fromDDL("depth long, a long, b long, conv long, ids string")
    digests = T.StructType.fromDDL("depth long, a long, b long, ends_sha256 string")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def as_batches(rows: Iterator[tuple], kinds: T.StructType) -> Iterator[pa.RecordBatch]:
        schema, held = to_arrow_schema(kinds), []
        for row in rows:
            held.append(row)
            if len(held) == 1000:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held))), schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*held))), schema=schema)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        node, first, ids, size = None, None, [], 0
        for *own, conv in rows_of(batches):
            if ids and (own != node or size >= ENDS_BLOCK):
                yield (*node, first, ",".join(ids))
                ids, size = [], 0
            if not ids:
                node, first = own, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if ids:
            yield (*node, first, ",".join(ids))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        node, sha = None, None
        for *own, _, ids in rows_of(batches):
            if own != node:
                if sha:
                    yield (*node, sha.hexdigest())
                node, sha = own, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        if sha:
            yield (*node, sha.hexdigest())

    packed = (
        ends.select(*NODE, "conv")
        .repartitionByRange(*NODE, "conv")
        .sortWithinPartitions(*NODE, "conv")
        .mapInArrow(lambda batches: as_batches(joined(batches), blocks), blocks)
    )
    return (
        packed.repartition(*NODE)
        .sortWithinPartitions(*NODE, "conv")
        .mapInArrow(lambda batches: as_batches(digested(batches), digests), digests)
    )


def _tops(paths: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """For each conversation (conv) the depth (cut) and name of the first node on its path that weighs at
    most ``limit``; a conversation without one is missing."""
    heavy = nodes.where(F.col("weight") > limit).select(*NODE)
    above = paths.join(broadcast_if_small(heavy), list(NODE), "left_semi")
    cuts = above.groupBy("conv", apart("conv")).agg(F.max("depth").alias("cut"))
    cuts = cuts.select("conv", (F.col("cut") + 1).alias("depth"))
    found = paths.select("conv", *NODE).join(cuts, ["conv", "depth"])
    return found.select("conv", F.col("depth").alias("cut"), F.xxhash64(*NODE).alias("shard"))


def _forward(nodes: DataFrame, in_memory: int) -> DataFrame:
    """``nodes`` of whole shards with n_children, n_leaves and saved_tokens.

    ``gain`` is what a node saves itself; children, leaves and saved hold what came from below
    other shards. A top's totals stay with it.
    """
    added = "n_children long, n_leaves long, saved_tokens long"
    kinds = T.StructType(nodes.schema.fields + T.StructType.fromDDL(added).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kinds)
        waiting = SpillingQueue(in_memory)
        for batch in batches:
            told: list[tuple[int, int, int]] = []
            values = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for i in range(batch.num_rows):
                depth = values["depth"][i]
                at = (-depth, values["a"][i], values["b"][i])
                children, leaves = values["children"][i], values["leaves"][i]
                saved = values["saved"][i] + values["gain"][i]
                while (message := waiting.least()) and message[:3] <= at:
                    if message[:3] < at:
                        raise ValueError("totals for a node that is not in the shard")
                    waiting.pop()
                    children += 1
                    leaves += message[3]
                    saved += message[4]
                leaves = leaves or 1
                told.append((children, leaves, saved))
                if not values["top"][i]:
                    up = (1 - depth, values["up_a"][i], values["up_b"][i])
                    waiting.push((*up, leaves, saved))
            arrays = [*batch.columns, *(pa.array(x, pa.int64()) for x in zip(*told))]
            if told:
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        if waiting.least():
            raise ValueError("totals for a node that is not in the shard")

    sorted_ = nodes.repartition("shard").sortWithinPartitions(F.desc("depth"), "a", "b")
    return sorted_.mapInArrow(run, kinds)


def _upwards(done: DataFrame) -> DataFrame:
    """What the tops of finished shards hand to their parents, summed up."""
    return (
        done.where("top")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
        .agg(
            F.count(F.lit(1)).alias("children"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved"),
        )
    )


def prefix_trie(
    turns: DataFrame,
    conversations: DataFrame,
    shard_weight: int = SHARD_WEIGHT,
    in_memory: int = MOST_IN_MEMORY,
) -> DataFrame:
    """A row for each node of the trie of ``turns`` (conv, depth from 1, item, words, length).

    ``conversations`` (conv, length) also names those without turns, which end in the root. The result
    has conv_id (the smallest through the node), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (over the subtree: words that all but one conversation need not process again) and ends_sha256 (of the
    conversations that end there). No conversations give no node.

    Conversations through one node are counted by partial aggregates, however many they are. A task holds
    at most ``in_memory`` messages. Only nodes above the weight limit wait for a next round,
    and there are as many rounds as the logarithm of the whole weight to the base ``shard_weight``; a
    conversation that outweighs a shard by itself is a chain that one task reads from a stream.
    """
    root = conversations.select(
        "conv",
        F.lit(0).cast("long").alias("depth"),
        *[F.lit(0).cast("long").alias(x) for x in "ab"],
        *[F.lit(None).cast("long").alias(f"up_{x}") for x in "ab"],
        F.lit(0).cast("long").alias("words"),
        "length",
        F.lit(0).cast("long").alias("check"),
    )
    paths = snapshot(_named(turns).unionByName(root), "trie-paths")
    nodes = snapshot(_nodes(paths), "trie-nodes")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    ends = _ends_digests(paths.where("depth = length"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
        F.col("conv").alias("parent"),
    )
    nodes = nodes.join(parents, ["depth", "up_a", "up_b"], "left").join(ends, list(NODE), "left")
    nodes = nodes.select(
        *NODE, "up_a", "up_b", "conv", "parent", "n_convs", "weight",
        ((F.col("n_convs") - 1) * F.col("words")).alias("gain"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    nodes = snapshot(nodes, "trie-nodes")

    heaviest = nodes.agg(F.max("weight")).first()[0] or 0
    done: DataFrame | None = None
    lower, limit = 0, shard_weight
    while done is None or lower < heaviest:
        # The shards of this round; the root's own when the whole trie fits.
        own = nodes.where((F.col("weight") > lower) & (F.col("weight") <= limit))
        if heaviest <= limit:
            own = own.withColumns({"cut": F.lit(0).cast("long"), "shard": F.lit(0).cast("long")})
        else:
            own = own.join(_tops(paths, nodes, limit), "conv")
        own = own.withColumn("top", F.col("depth") == F.col("cut")).drop("cut")
        if done is None:
            own = own.withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")})
        else:
            own = own.join(_upwards(done), list(NODE), "left")
            own = own.na.fill(0, ["children", "leaves", "saved"])
        found = snapshot(_forward(own, in_memory), "trie-totals")
        done = found if done is None else done.unionByName(found)
        lower, limit = limit, limit * shard_weight
    return done.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )


def conversation_trie(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shard_weight: int = SHARD_WEIGHT,
    in_memory: int = MOST_IN_MEMORY,
) -> DataFrame:
    """The trie of the conversations in ``df``, rebuilt with shared beginnings.

    Null role and text are empty; null turns come first, equal ones in the order of their digests;
    repeated rows are repeated turns; rows without a conversation are left out. Further
    columns are not looked at. An empty table gives an empty result.
    """
    ordered = ordered_turns(df, conv_id, turn, role, text)
    turns, conversations = with_shared_beginnings(ordered)
    return prefix_trie(turns, conversations, shard_weight, in_memory)
