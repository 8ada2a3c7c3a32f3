"""Applying column and value standards to data. The rules are this library's own: the control
tables hold the standards, and say nothing of how they are applied."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import canonical_text, cast_or_null, column, free_name
from guidepost.plans import MAX_BROADCAST_BYTES, apart, byte_total, is_small
from guidepost.sources import snapshot

# A mapped column: its sources in the order of the data, its new name, and its type.
Mapped = tuple[list[str], str, str]


def _spelled_as(spark: SparkSession, name: str) -> str:
    """``name`` in the form in which the session tells columns apart."""
    return name if spark.conf.get("spark.sql.caseSensitive") == "true" else name.lower()


def _mapped_columns(
    df: DataFrame, mapping: DataFrame, types: Mapping[str, str] | None, absent: str
) -> list[Mapped]:
    if absent not in ("error", "skip"):
        raise ValueError(f"absent must be 'error' or 'skip', not {absent!r}")
    spark = df.sparkSession
    positions = {_spelled_as(spark, name): i for i, name in enumerate(df.columns)}
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    source = F.col("source_name") if exact else F.lower("source_name")
    rows = mapping.select(
        "source_name", source.alias("spelling"), "dest_name", "data_type"
    ).distinct()
    is_known = F.coalesce(F.col("spelling").isin(list(positions)), F.lit(False))
    # A row for each column of the result, and for those that have no source at all.
    found = (
        rows.groupBy("dest_name")
        .agg(
            F.collect_set(F.when(is_known, F.col("spelling"))).alias("sources"),
            F.count_distinct(F.when(is_known, F.col("data_type"))).alias("types"),
            F.min(F.when(is_known, F.col("data_type"))).alias("data_type"),
            F.count_if(~is_known).alias("absent"),
            F.min(F.when(~is_known, F.coalesce("source_name", F.lit("None")))).alias("example"),
        )
        .where((F.size("sources") > 0) | F.lit(absent == "error"))
        .collect()
    )
    names = sorted(row["example"] for row in found if row["absent"])[:20]
    if names and absent == "error":
        raise ValueError(f"mapped columns are not in the data: {names}")
    names = sorted(row["dest_name"] for row in found if row["types"] > 1)[:20]
    if names:
        raise ValueError(f"several types for one destination column: {names}")
    spelling = types or {}
    mapped = []
    for row in found:
        at = sorted(positions[name] for name in row["sources"])
        data_type = spelling.get(row["data_type"], row["data_type"])
        mapped.append((at, [df.columns[i] for i in at], row["dest_name"], data_type))
    mapped.sort(key=lambda m: (m[0], m[2]))
    return [m[1:] for m in mapped]


def _first_value(df: DataFrame, sources: list[str], data_type: str) -> Column:
    return F.coalesce(*[cast_or_null(df, source, data_type) for source in sources])


def absent_columns(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """The distinct ``source_name``s of a mapping that ``df`` has no column for."""
    known = [_spelled_as(df.sparkSession, name) for name in df.columns]
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    source = F.col("source_name") if exact else F.lower("source_name")
    return mapping.where(~source.isin(known)).select("source_name").distinct()


def _is_lost(df: DataFrame, sources: list[str], data_type: str) -> Column:
    """Whether one of a column's sources has a value that does not fit."""
    lost = [
        column(source).isNotNull() & cast_or_null(df, source, data_type).isNull()
        for source in sources
    ]
    return reduce(Column.__or__, lost)


def apply_column_mapping(
    df: DataFrame,
    mapping: DataFrame,
    types: Mapping[str, str] | None = None,
    absent: str = "error",
    bad_casts: Observation | None = None,
) -> DataFrame:
    """``df`` with the mapped columns only, renamed and cast, in the order of ``df``.

    A value that does not fit its new type becomes null; ``count_bad_casts`` counts those. Where
    several sources have one destination, the first of them in ``df`` that is not null counts.
    A mapping belongs to a target, and a target's extractions may differ in their columns: with
    ``absent="skip"`` sources that ``df`` lacks are left out (``absent_columns`` reports them),
    else they are an error. Names match as the session tells columns apart.

    ``types`` translates type names of the control tables to Spark's, e.g.
    ``{"datetime": "timestamp"}``. Only the mapping is read here; the data needs no shuffle.

    ``bad_casts`` counts what ``count_bad_casts`` counts in the pass that first uses the result, e.g.
    writes it; afterwards ``bad_casts.get`` has the counts by destination column. An
    observation serves one result.
    """
    mapped = _mapped_columns(df, mapping, types, absent)
    seen = df
    if bad_casts is not None:
        if not mapped:
            raise ValueError("no column is mapped, so there are no casts to observe")
        seen = df.observe(
            bad_casts,
            *[F.count_if(_is_lost(df, sources, kind)).alias(dest) for sources, dest, kind in mapped],
        )
    return seen.select(
        *[_first_value(df, sources, kind).alias(dest) for sources, dest, kind in mapped]
    )


def count_bad_casts(
    df: DataFrame,
    mapping: DataFrame,
    types: Mapping[str, str] | None = None,
    absent: str = "error",
) -> DataFrame:
    """How many values each mapped column loses to a bad cast, in one scan of ``df``.

    A row counts if one of the column's sources has a value there that does not fit.
    """
    mapped = _mapped_columns(df, mapping, types, absent)

    counts = df.agg(
        *[
            F.count_if(_is_lost(df, sources, data_type)).alias(f"lost_{i}")
            for i, (sources, _, data_type) in enumerate(mapped)
        ]
    )
    rows = [
        F.struct(F.lit(dest).alias("dest_name"), F.col(f"lost_{i}").alias("bad_casts"))
        for i, (_, dest, _) in enumerate(mapped)
    ]
    return counts.select(F.inline(F.array(*rows)))


def standardize_values(
    df: DataFrame,
    value_targets: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with known spellings of a value replaced by the canonical value.

    A value matches a target of its column if both are equal without outer blanks and
    capitals. If several targets match, the smallest is used; values without one stay. Column
    names match as the session tells columns apart.

    The targets are read once, into a table with a directory for each column, and measured.
    A small directory is broadcast, so ``df`` is not shuffled. Of a larger one, the targets that
    the distinct values of ``df`` need are looked up first and broadcast if they are small;
    only beyond that is it a shuffle join, in which adaptive execution splits frequent values.
    """
    spark = df.sparkSession
    names = {_spelled_as(spark, name): name for name in df.columns}
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    dest = F.col("dest_name") if exact else F.lower("dest_name")
    standards = (
        value_targets.select(dest.alias("dest_name"), "target_value")
        .where(F.col("dest_name").isin(list(names)))
        .groupBy("dest_name", canonical_text(F.col("target_value")).alias("spelling"))
        .agg(F.min("target_value").alias("canonical"))
        .where(F.col("spelling").isNotNull())
    )
    canonical = snapshot(standards, "standards", partition_by=["dest_name"])
    # At most one row for each column of df.
    sizes = {
        row["dest_name"]: row["bytes"]
        for row in canonical.groupBy("dest_name")
        .agg(byte_total(canonical, "spelling", "canonical").alias("bytes"))
        .collect()
    }
    kinds = {names[n]: df.schema[names[n]].dataType for n in sizes}
    not_text = [n for n, kind in kinds.items() if not isinstance(kind, T.StringType)]
    if not_text:
        raise ValueError(f"only text columns have standard values, not {not_text}")

    result = df
    known, found = free_name(df, "spelling"), free_name(df, "canonical")
    for key in sorted(sizes):
        name = names[key]
        lookup = canonical.where(F.col("dest_name") == F.lit(key)).select(
            F.col("spelling").alias(known), F.col("canonical").alias(found)
        )
        small = sizes[key] <= max_broadcast_bytes
        if not small:
            # The spellings that the data has may be few where the standards are many.
            present = df.select(canonical_text(column(name)).alias(known), apart(name)).distinct()
            used = lookup.join(present.select(known), known, "left_semi").distinct()
            lookup = snapshot(used, "standards-used")
            small = is_small(lookup, max_broadcast_bytes)
        if small:
            lookup = F.broadcast(lookup)
        result = (
            result.join(lookup, canonical_text(column(name)) == F.col(known), "left")
            .withColumn(name, F.coalesce(F.col(found), column(name)))
            .drop(known, found)
        )
    return result
