"""Mixing sources to target weights by hash thresholds, without sorting documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guidepost.functions import column
from guidepost.llm.frames import fresh, word_count
from guidepost.plans import is_small
from guidepost.sources.scratch import snapshot

# A document's point: the first 48 bits of the MD5 of its id and text, read in four digits.
DIGIT_BITS = 12
DIGITS = 4
POINT_BITS = DIGIT_BITS * DIGITS


def mixing_point(doc_id: Column, text: Column) -> Column:
    """A number below 2**48 that depends on id and text alone; nulls are left out."""
    digest = F.md5(F.concat_ws(":", doc_id.cast("string"), text))
    return F.conv(F.substring(digest, 1, POINT_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], share: float, max_copies: int
) -> DataFrame:
    """A row for each source: source, source_size and target.

    Sources in code point order, null last, weigh ``weights`` in turn. They divide ``share`` of
    all sizes; a target stops at ``max_copies`` times the source's size and what it leaves
    goes to the others by weight. In the order of the level at which they stop, the sources that
    stop come first, so running sums find the level at which the rest ends.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = per_source.select(
        "source",
        "source_size",
        F.get(F.array(*map(F.lit, weights)), turn).cast("double").alias("weight"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("total"),
    ).withColumn("most", (F.col("source_size") * max_copies).cast("double"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    stopped = weighed.withColumn("stops", level * F.col("weight") > F.col("most"))
    rest_total = F.first("total").over(everything) - F.sum(
        F.when(F.col("stops"), F.col("most")).otherwise(0.0)
    ).over(everything)
    rest_weight = F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(everything)
    return stopped.select(
        "source",
        "source_size",
        F.when(F.col("stops"), F.col("most"))
        .otherwise(rest_total * F.col("weight") / rest_weight)
        .alias("target"),
    )


def cut_points(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``whole`` and ``cut``: a document is taken ``whole`` times, and once more
    if its point is at most ``cut``.

    For each digit of the points a histogram sums sizes by source and digit, over the rows of
    the boundary bucket only, and running sums find the bucket in which the budget ends. Equal
    points stay together; the last of them is taken if that comes closer to the budget.
    """
    small = is_small(targets)
    held = lambda df: F.broadcast(df) if small else df  # noqa: E731  a row for each source
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    found = targets.withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long")).select(
        "*",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("below"),
        F.lit(0).cast("long").alias("inside"),
    )
    for digit in range(DIGITS):
        rest = POINT_BITS - DIGIT_BITS * (digit + 1)
        histogram = (
            sizes.join(
                held(found.select(F.col("source").alias("own"), "prefix")),
                F.col("source").eqNullSafe(F.col("own"))
                & (F.shiftright("point", rest + DIGIT_BITS) == F.col("prefix")),
            )
            .groupBy("source", F.shiftright("point", rest).alias("next"))
            .agg(F.sum("size").alias("bucket_size"))
        )
        running = Window.partitionBy("own").orderBy("next")
        steps = (
            histogram.withColumnRenamed("source", "own")
            .withColumn("upto", F.sum("bucket_size").over(running))
            .withColumn("last", F.lead("next").over(running).isNull())
        )
        joined = steps.join(held(found), F.col("own").eqNullSafe(F.col("source")))
        reached = joined.where((F.col("below") + F.col("upto") > F.col("budget")) | F.col("last"))
        boundary = reached.groupBy("own").agg(
            F.min_by(F.struct("next", "upto", "bucket_size"), "next").alias("at")
        )
        found = snapshot(
            found.join(held(boundary), F.col("source").eqNullSafe(F.col("own")), "left").select(
                "source",
                "source_size",
                "target",
                "whole",
                "budget",
                F.coalesce("at.next", F.lit(-1)).alias("prefix"),
                (F.col("below") + F.coalesce(F.expr("at.upto - at.bucket_size"), F.lit(0))).alias(
                    "below"
                ),
                F.coalesce("at.bucket_size", F.lit(0)).alias("inside"),
            ),
            "mixing-boundary",
        )
    with_last = F.abs(F.col("below") + F.col("inside") - F.col("budget"))
    without_last = F.abs(F.col("below") - F.col("budget"))
    cut = F.when(with_last < without_last, F.col("prefix")).otherwise(F.col("prefix") - 1)
    cut = F.when(F.col("budget") > 0, cut).otherwise(-1)  # nor are texts without words taken again
    return found.select("source", "source_size", "target", "whole", cut.alias("cut"))


def mixing_plan(
    sizes: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    max_copies: int = 2,
) -> DataFrame:
    """source, source_size, target, whole and cut of each source of ``sizes``.

    ``sizes`` has the columns source, size and point and is read several times, so it should be
    a stored table.
    """
    targets = snapshot(source_targets(sizes, weights, share, max_copies), "mixing-targets")
    return cut_points(sizes, targets)


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return docs.select(
        column(doc_id).alias("id"),
        column(source).alias("source"),
        word_count(column(text)).alias("size"),
        mixing_point(column(doc_id), column(text)).alias("point"),
    )


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with source and point, each with its source's row of the plan and its copies."""
    named = plan.withColumnRenamed("source", "plan_source")
    joined = rows.join(
        F.broadcast(named) if is_small(named) else named,
        F.col("source").eqNullSafe(F.col("plan_source")),
    )
    return joined.withColumn("copies", F.col("whole") + (F.col("point") <= F.col("cut")).cast("int"))


def mix_report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """What the mix takes of each document: id, size, source_size, target, taken, copies.

    Sizes are words. A null text has none; a null source is a source of its own. Repeated rows
    (same id and text) have the same point and are taken or left together. An empty table gives
    an empty result. No row is taken more often than ``max_copies``. Other columns are not looked at. ``options``
    are those of ``mixing_plan``.
    """
    sizes = snapshot(_sizes(docs, doc_id, text, source), "mixing-sizes")
    return _with_copies(sizes, mixing_plan(sizes, **options)).select(
        F.col("id").alias(doc_id),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as often as they are taken, in their columns.

    Rules and edge cases are those of ``mix_report``. Rows without words are not taken when
    their source has no words at all.
    """
    sizes = snapshot(_sizes(docs, doc_id, text, source).drop("id"), "mixing-sizes")
    plan = mixing_plan(sizes, **options)
    row = fresh(docs, "mixed_row")
    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias(row),
        column(source).alias("source"),
        mixing_point(column(doc_id), column(text)).alias("point"),
    )
    copies = _with_copies(rows, plan).where("copies > 0")
    repeated = copies.select(row, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(f"{row}.*")
