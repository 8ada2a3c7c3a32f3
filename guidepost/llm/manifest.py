"""Merkle trees over a dataset, with a proof for each row, by sibling-shift self-joins.

A tree's nodes have a level and an index. Each level is joined with itself: the node in slot zero
of a run of ``arity`` computes the indices of its siblings, which are its own plus an offset (for
two: XOR 1), gets their digests by an equijoin, and emits the parent, a node of the next level.
A run is stored once, for all its nodes; a node's slot follows from its index.

Digests are 32 bytes in all tables and hexadecimal text where they are digested again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guidepost.functions import column
from guidepost.llm.frames import fresh
from guidepost.llm.ordinals import ordinals
from guidepost.plans import broadcast_if_small
from guidepost.sources.scratch import snapshot

ARITY = 8
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Tampered with: one row of three, by the checksum of its id.
TAMPERED_OF = 3


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(told, F.lit("-"))


def as_text(digest_: Column) -> Column:
    return F.lower(F.hex(digest_))


def _joined(digests: Column) -> Column:
    return F.concat_ws("", F.transform(digests, as_text))


def sibling_runs(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """The runs (tree, up, width, run) of nodes (tree, index, digest, width).

    ``width`` is the number of nodes of the tree on this level, ``run`` the digests from left to
    right, ``up`` the parent's index. A row meets at most ``arity`` others, whatever the size of a tree.
    """
    offsets = F.sequence(F.lit(0).cast("long"), F.lit(arity - 1).cast("long"))
    heads = nodes.where(F.col("index") % arity == 0)
    asked = heads.select("tree", "index", "width", F.explode(offsets).alias("slot"))
    asked = asked.withColumn("sibling", F.col("index") + F.col("slot")).where("sibling < width")
    told = nodes.select("tree", F.col("index").alias("sibling"), "digest")
    digests = F.array_sort(F.collect_list(F.struct("slot", "digest")))
    runs = asked.join(told, ["tree", "sibling"]).groupBy("tree", "index").agg(
        F.first("width").alias("width"), F.transform(digests, lambda d: d["digest"]).alias("run")
    )
    return runs.select("tree", F.floor(F.col("index") / arity).alias("up"), "width", "run")


def parents(runs: DataFrame, arity: int = ARITY) -> DataFrame:
    """The nodes above the runs of a level."""
    return runs.select(
        "tree",
        F.col("up").alias("index"),
        F.unhex(F.sha2(_joined(F.col("run")), 256)).alias("digest"),
        F.ceil(F.col("width") / arity).alias("width"),
    )


def forest(leaves: DataFrame, purpose: str, arity: int = ARITY) -> tuple[DataFrame, DataFrame]:
    """Runs on the way up, and the roots, of trees (tree, index, digest, width).

    The first result has, for each run of leaves, tree, up and ``runs``: its own digests and
    those of the runs of its ancestors, up to the one below the root. The second has tree and digest. A lone
    leaf is its tree's root and in no run. Every level is a stored table; there are as many
    as the logarithm of the largest tree's width, to the base ``arity``.
    """
    nodes = leaves.select("tree", "index", "digest", "width")
    widest = nodes.agg(F.max("width")).first()[0] or 0
    levels, roots = [], nodes.where("width = 1")
    while widest > 1:
        runs = sibling_runs(nodes.where("width > 1"), arity)
        levels.append(snapshot(runs, f"{purpose}-runs"))
        nodes = parents(levels[-1], arity)
        roots = roots.union(nodes.where("width = 1"))
        widest = -(-widest // arity)

    kind = "array<array<binary>>"
    if not levels:
        none = F.array().cast(kind).alias("runs")
        empty = leaves.select("tree", F.col("index").alias("up"), none).limit(0)
        return empty, roots.select("tree", "digest")
    above: DataFrame | None = None
    for level in reversed(levels):
        own = level.select("tree", "up", F.array("run").alias("runs"))
        if above is not None:
            rest = above.select("tree", F.col("up").alias("next"), F.col("runs").alias("rest"))
            own = own.withColumn("next", F.floor(F.col("up") / arity))
            own = own.join(rest, ["tree", "next"], "left")
            rest = F.coalesce("rest", F.array().cast(kind))  # null below a root
            own = own.select("tree", "up", F.concat("runs", rest).alias("runs"))
        above = snapshot(own, f"{purpose}-paths")
    return above, roots.select("tree", "digest")


def _path(runs: Column, index: Column, arity: int) -> Column:
    """Slots and runs on the way up from a leaf; a lone leaf (null) has none."""

    def step(run: Column, level: Column) -> Column:
        slot = F.floor(index / F.pow(F.lit(arity), level)) % arity
        return F.struct(slot.cast("int").alias("slot"), run.alias("run"))

    kind = "array<struct<slot:int,run:array<binary>>>"
    return F.coalesce(F.transform(runs, step).cast(kind), F.array().cast(kind))


def _around(step: Column) -> tuple[Column, Column]:
    """The digests left and right of a slot, as text."""
    left = F.slice(step["run"], F.lit(1), step["slot"])
    right = F.slice(step["run"], step["slot"] + 2, F.size(step["run"]))
    return _joined(left), _joined(right)


def siblings(path: Column) -> Column:
    """The digests of a path without the row's own, level by level, left to right, in one text."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(*_around(step))))


def folded(leaf: Column, path: Column) -> Column:
    """The root, as text, that a leaf's digest (as text) and its siblings give."""

    def up(below: Column, step: Column) -> Column:
        left, right = _around(step)
        return digest(left, below, right)

    return F.aggregate(path, leaf, up)


def manifest(
    rows: DataFrame, key: str, group: str, leaf: str = "leaf", arity: int = ARITY
) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``path``, the proof of ``leaf`` up to the root.

    ``leaf`` is a digest of 32 bytes, as are the others. A path has for each level the slot in the run
    and the run's digests. Rows of a ``group`` are leaves of one tree, in the order of ``key`` (null
    first; equal keys by their digest). The groups' roots, in the order of the groups (null first, bytewise),
    are the leaves of the tree whose root is ``root``. If ``rows`` has columns of these names, the
    new ones get an underscore. An empty table gives an empty result.
    """
    inner = rows.select(
        F.struct(*[column(c) for c in rows.columns]).alias("row"),
        column(group).alias("group"),
        column(key).alias("key"),
        column(leaf).alias("digest"),
    )
    order = [F.col("key").asc_nulls_first(), F.col("digest")]
    placed = ordinals(inner, "group", order, "manifest-rows").select(
        "row",
        "digest",
        F.col("first").alias("tree"),
        F.col("ordinal").alias("index"),
        F.col("size").alias("width"),
    )
    paths, subroots = forest(placed, "manifest", arity)
    # Trees are named by the place of their first row, so their order is that of the groups.
    one_tree = snapshot(subroots, "manifest-subroots").withColumn("all", F.lit(0))
    top = ordinals(one_tree, "all", [F.col("tree")], "manifest-trees").select(
        F.col("tree").alias("of"),
        F.col("first").alias("tree"),
        F.col("ordinal").alias("index"),
        F.col("size").alias("width"),
        "digest",
    )
    top_paths, roots = forest(top, "manifest-top", arity)
    run = F.floor(F.col("index") / arity).alias("up")
    ends = top.withColumn("up", run).join(top_paths, ["tree", "up"], "left").join(
        F.broadcast(roots.withColumnRenamed("digest", "root")), "tree"
    )
    ends = ends.select(
        F.col("of").alias("tree"),
        F.col("digest").alias("subroot"),
        "root",
        _path(F.col("runs"), F.col("index"), arity).alias("above"),
    )
    ends = broadcast_if_small(snapshot(ends, "manifest-ends"))
    found = placed.withColumn("up", run).join(paths, ["tree", "up"], "left").join(ends, "tree")
    return found.select(
        "row.*",
        F.col("subroot").alias(fresh(rows, "subroot")),
        F.col("root").alias(fresh(rows, "root")),
        F.concat(_path(F.col("runs"), F.col("index"), arity), "above").alias(fresh(rows, "path")),
    )


def verified_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    doc_id: str = "doc_id",
    group: str = "lang",
    text: str = "text",
    arity: int = ARITY,
) -> DataFrame:
    """Each row's leaf, subroot, root and proof, and whether a tampered copy still proves true.

    A leaf is the digest of ``fields``. Where ``TAMPERED_OF`` divides the checksum of the id, the
    copy has the capitals A-Z of its text in lower case (a null text stays null, a row without an id is not
    tampered with); all other copies are the rows themselves. ``folded_root`` is computed from
    the copy's leaf and the original siblings, ``verified`` tells whether it is the root.

    Repeated rows are leaves of their own with equal digests; they stand side by side, and which is
    first makes no difference to the roots. Null groups form one group. Texts are digested where they
    are read; only digests are shuffled. Further columns are not looked at; an empty table gives an
    empty result.
    """
    lowered = F.translate(column(text), CAPITALS, CAPITALS.lower())
    changed = F.crc32(column(doc_id).cast("string").cast("binary")) % TAMPERED_OF == 0

    def leaf(of_text: Column) -> Column:
        return digest(*[field(of_text if name == text else column(name)) for name in fields])

    rows = docs.select(
        column(doc_id).alias("key"),
        column(group).alias("group"),
        F.unhex(leaf(column(text))).alias("leaf"),
        F.when(changed, F.unhex(leaf(lowered))).alias("copy"),
    )
    # Stored, as sorting by range reads its input twice; that must not be the texts.
    found = manifest(snapshot(rows, "manifest-digests"), "key", "group", "leaf", arity)
    found = found.select(
        F.col("key").alias(doc_id),
        as_text(F.col("leaf")).alias("leaf"),
        as_text(F.col("subroot")).alias("subroot"),
        as_text(F.col("root")).alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded(as_text(F.coalesce("copy", "leaf")), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
