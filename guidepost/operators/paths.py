"""Which lake directories a target must read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import flag_is_set, partition_time
from guidepost.operators.lookups import is_target
from guidepost.plans import (
    MAX_BROADCAST_BYTES,
    bucket_times,
    byte_total,
    distinct_keys,
    hold_time,
    is_small,
    split_windows,
    steps,
    width_for,
)
from guidepost.plans.ranges import WIDTHS
from guidepost.sources import snapshot

INDEX_KEYS = ["project", "theme", "extraction_name"]

PATH_COLUMNS = [
    "extraction_id",
    "directory",
    "extraction_name",
    "target_id",
    "delta_start",
    "delta_end",
]


def extraction_windows(
    targets: DataFrame, extractions: DataFrame, theme: str | None, target: str | None
) -> DataFrame:
    """Extractions of the chosen targets with their index keys and windows."""
    wanted = distinct_keys(targets.where(is_target(theme, target)), "target_id")
    return extractions.select(
        "extraction_id", *INDEX_KEYS, "target_id", "delta_start", "delta_end"
    ).join(wanted, "target_id")


def resolve_paths(
    targets: DataFrame,
    extractions: DataFrame,
    index: DataFrame,
    theme: str | None = None,
    target: str | None = None,
    mode: str = "flag",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Directories of the partition index that belong to the extractions of a target.

    ``mode="window"`` keeps partitions whose hour lies in the extraction's delta window, both
    ends included. ``mode="flag"`` keeps partitions whose delta flag is set, at any time.

    The windows of a target are few and the index is long, so the windows are computed and
    measured first (small jobs over the control tables); the index is read when the result is.
    Small windows are broadcast, and only what matches is shuffled, once, to merge repeats.
    Otherwise both sides are shuffled, the index once and without repeating a row, whatever the
    lengths of the windows are. In window mode the years of all windows bound the scan of the index; only
    if there are long windows, a first scan of its dates finds the span to which they are cut.
    """
    if mode not in ("window", "flag"):
        raise ValueError(f"mode must be 'window' or 'flag', not {mode!r}")
    windows = snapshot(extraction_windows(targets, extractions, theme, target), "windows")
    match = _match_windows if mode == "window" else _match_flags
    return match(windows, index, max_broadcast_bytes).select(*PATH_COLUMNS).distinct()


def _match_windows(windows: DataFrame, index: DataFrame, max_bytes: int) -> DataFrame:
    held = hold_time(windows, "delta_start", "delta_end").distinct()
    years = held.agg(
        F.year(F.min("delta_start")).alias("first"), F.year(F.max("delta_end")).alias("last")
    ).first()
    time = partition_time(index, like=windows.schema["delta_start"].dataType)
    entries = _years(index, years["first"], years["last"]).select(
        *INDEX_KEYS, "directory", time.alias("partition_time")
    )
    cut = held.withColumns({"cut_start": F.col("delta_start"), "cut_end": F.col("delta_end")})
    width = width_for(cut, "cut_start", "cut_end")
    if width != WIDTHS[0]:
        cut = snapshot(_cut_to_span(held, entries), "windows-cut")
        width = width_for(cut, "cut_start", "cut_end")
    pieces = steps("cut_start", "cut_end", width)
    small = cut.agg(byte_total(cut, times=pieces).alias("bytes")).first()["bytes"] <= max_bytes
    found = _join_entries(
        bucket_times(entries, "partition_time", width),
        split_windows(cut, "cut_start", "cut_end", width).drop("cut_start", "cut_end"),
        [*INDEX_KEYS, "bucket"],
        small,
    )
    return found.where(F.col("partition_time").between(F.col("delta_start"), F.col("delta_end")))


def _cut_to_span(windows: DataFrame, entries: DataFrame) -> DataFrame:
    """``windows`` with ``cut_start`` and ``cut_end``, their part between the first and the last
    entry; those without one are left out."""
    span = entries.agg(F.min("partition_time").alias("first"), F.max("partition_time").alias("last"))
    kind = windows.schema["delta_start"].dataType
    first, last = (F.lit(value).cast(kind) for value in span.first())
    cut = windows.withColumns(
        {"cut_start": F.greatest("delta_start", first), "cut_end": F.least("delta_end", last)}
    )
    return hold_time(cut.where(first.isNotNull()), "cut_start", "cut_end")


def _years(index: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """The index without years that no window touches; numeric years are pruned by the scan."""
    if first is None or not isinstance(index.schema["year"].dataType, T.NumericType):
        return index
    return index.where(F.col("year").between(first, last))


def _match_flags(windows: DataFrame, index: DataFrame, max_bytes: int) -> DataFrame:
    entries = index.where(flag_is_set(index, "delta_flag")).select(*INDEX_KEYS, "directory")
    small = is_small(windows, max_bytes)
    return _join_entries(entries, windows.distinct(), INDEX_KEYS, small)


def _join_entries(
    entries: DataFrame, windows: DataFrame, keys: list[str], small: bool
) -> DataFrame:
    """Entries with the windows of equal keys. A shuffle join merges repeated entries first; after
    a broadcast join only matching ones are left, and the result merges those."""
    if small:
        return entries.join(F.broadcast(windows), keys)
    return entries.distinct().join(windows, keys)
