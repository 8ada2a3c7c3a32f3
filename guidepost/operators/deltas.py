from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guidepost.functions import column, free_name
from guidepost.plans import MAX_BROADCAST_BYTES, broadcast_if_small, distinct_keys
from guidepost.sources import Version, publish, published_versions, read_version, snapshot


def advance_deltas(
    table: DataFrame,
    ids: DataFrame,
    key: str = "extraction_id",
    start: str = "delta_start",
    end: str = "delta_end",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """New version of a table with the windows of the given ids moved on.

    A moved window starts where the old one ended and keeps its length. ``key`` names the
    column that ``ids`` holds: ``extraction_id`` or ``target_id``. The windows are those of the
    extractions, or, with other ``start`` and ``end`` columns, the delta values that targets have
    of their own. Other rows stay as they are, and nothing is written: pass the result to
    ``write_table`` under a new path.

    The ids are stored and measured; small ones are broadcast, so the table is not shuffled.
    The rule is this library's own: the source system hides its rule in a procedure.
    """
    if key not in ("extraction_id", "target_id"):
        raise ValueError(f"key must be 'extraction_id' or 'target_id', not {key!r}")
    first, last = column(start), column(end)
    flag = free_name(table, "is_moved")
    found = snapshot(distinct_keys(ids, key).where(F.col(key).isNotNull()), "moved")
    moved = broadcast_if_small(found.withColumn(flag, F.lit(True)), max_broadcast_bytes)
    return (
        table.join(moved, key, "left")
        .withColumns(
            {
                start: F.when(F.col(flag), last).otherwise(first),
                end: F.when(F.col(flag), last + (last - first)).otherwise(last),
            }
        )
        .select(*[column(name) for name in table.columns])
    )


def publish_windows(spark: SparkSession, root: str, table: DataFrame) -> Version:
    """``table`` as the first or next published version, without moving any window."""
    versions = published_versions(spark, root)
    after = versions[-1].number if versions else 0
    return publish(spark, root, {"table": table}, after)


def advance_published(
    spark: SparkSession,
    root: str,
    run: str,
    ids: DataFrame,
    key: str = "extraction_id",
    start: str = "delta_start",
    end: str = "delta_end",
) -> Version:
    """Move windows of a published table once for each run, and publish the result.

    ``run`` names what moves them, e.g. a day's load. Each version keeps the ids that it moved; ids that
    the same run has moved before are left out, so a run that is repeated, or repeated with more
    ids, moves no window twice. If nothing is left, no version is made and the current one
    returned. Readers (``read_version``) see the windows before or after, never a mixture; if another
    run publishes meanwhile, this one fails and can simply be repeated. Null ids move nothing.
    """
    versions = published_versions(spark, root)
    if not versions:
        raise LookupError(f"nothing is published below {root!r}")
    current = versions[-1]
    ledger = f"moved_by_{key}"
    asked = distinct_keys(ids, key).where(F.col(key).isNotNull())
    for version in versions:
        if version.run == run and ledger in version.tables:
            done = read_version(spark, root, ledger, version)
            asked = asked.join(done, key, "left_anti")
    asked = snapshot(asked, "moved-now")
    if not asked.limit(1).count():
        return current
    table = read_version(spark, root, version=current)
    moved = advance_deltas(table, asked, key, start, end)
    return publish(spark, root, {"table": moved, ledger: asked}, current.number, run)
