"""Places of rows within sorted groups, without a window over a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from guidepost.functions import column
from guidepost.plans import apart, broadcast_if_small
from guidepost.sources.scratch import snapshot

# monotonically_increasing_id keeps the partition above so many bits.
ROW_BITS = 33


def ordinals(df: DataFrame, group: str, order: Sequence[Column], purpose: str) -> DataFrame:
    """``df`` with ``first``, ``ordinal`` and ``size`` of its sorted groups.

    Rows are sorted by ``group`` (null first, a group like any other) and ``order``. ``ordinal``
    counts from 0 within the group, ``size`` is the group's number of rows, and ``first`` is the
    place of the group's first row in the whole table: it names the group and ascends with it.
    Rows that are equal in ``group`` and ``order`` stand in any order.

    A group of any size is split over tasks, as rows are dealt out by range of all sort columns; a
    task knows its own rows' places, and a table with a row for each task tells how many rows
    stand before. The result is made of a stored table.
    """
    keys = [column(group).asc_nulls_first(), *order]
    placed = snapshot(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id()),
        purpose,
    ).withColumn("part", F.shiftright("place", ROW_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # A row for each task that sorted.
    parts = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    row = F.col("place").bitwiseAND((1 << ROW_BITS) - 1)
    numbered = placed.join(F.broadcast(parts), "part").withColumn("place", F.col("before") + row)
    groups = numbered.groupBy(column(group).alias("own"), apart(group)).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("size")
    )
    groups = snapshot(groups.drop("_apart"), f"{purpose}-groups")
    return (
        numbered.join(broadcast_if_small(groups), column(group).eqNullSafe(F.col("own")))
        .withColumn("ordinal", F.col("place") - F.col("first"))
        .drop("part", "before", "place", "own")
    )
