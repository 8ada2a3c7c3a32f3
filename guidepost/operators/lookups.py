"""Questions to the control tables, each answered by equi joins.

Every function takes and returns DataFrames and runs nothing. Values such as the theme are
bound as literals, so quotes in them are harmless. Duplicates are kept unless the text says
otherwise. Join strategies are Spark's choice: it broadcasts what it measures to be small and
splits hot keys at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guidepost.functions import column, column_token, flag_is_set
from guidepost.plans import distinct_keys


def is_target(theme: str | None, target: str | None) -> Column:
    """Condition on the targets table; a part given as ``None`` is not restricted."""
    condition = F.lit(True)
    if theme is not None:
        condition = F.col("theme") == F.lit(theme)
    if target is not None:
        condition = condition & (F.col("target_name") == F.lit(target))
    return condition


def extractions_for_target(
    extractions: DataFrame, targets: DataFrame, target: str, theme: str | None = None
) -> DataFrame:
    """Extractions that feed a target, with their delta windows.

    Equal target names in several themes mix unless ``theme`` is given.
    """
    wanted = targets.where(is_target(theme, target)).select("target_id")
    return extractions.join(wanted, "target_id").select(
        "extraction_id", "delta_start", "delta_end"
    )


def comparison_info(
    targets: DataFrame,
    periods: DataFrame,
    destination_columns: DataFrame,
    theme: str,
    target: str,
) -> DataFrame:
    """What is needed to compare a target's outputs: template, deltas, period, key columns.

    The period and both column names are null where nothing matches.
    """
    names = destination_columns.select("dest_column_id", "dest_name")
    versions = names.toDF("version_column_id", "version_name")
    wanted = targets.where(is_target(theme, target)).select(
        "target_id",
        "theme",
        "target_name",
        "select_template",
        "delta_value_start",
        "delta_value_end",
        "period_id",
        "period_interval",
        "dest_column_id",
        "version_column_id",
        "mandatory_data",
    )
    return (
        wanted.join(periods.select("period_id", "period"), "period_id", "left")
        .join(names, "dest_column_id", "left")
        .join(versions, "version_column_id", "left")
        .select(
            "target_id",
            "theme",
            "target_name",
            "select_template",
            "delta_value_start",
            "delta_value_end",
            "period",
            "period_interval",
            "dest_name",
            "mandatory_data",
            "version_name",
        )
    )


def target_duration(
    targets: DataFrame, durations: DataFrame, theme: str, target: str
) -> DataFrame:
    """ISO 8601 duration code of every row of a target, null where it has none."""
    return (
        targets.where(is_target(theme, target))
        .select("duration_id")
        .join(durations.select("duration_id", "iso_code"), "duration_id", "left")
        .select("iso_code")
    )


def target_duration_code(
    targets: DataFrame, durations: DataFrame, theme: str, target: str
) -> str | None:
    """The one duration code of a target; an error if there is no row or no single code."""
    codes = target_duration(targets, durations, theme, target).distinct().take(2)
    if not codes:
        raise LookupError(f"no target {target!r} in theme {theme!r}")
    if len(codes) > 1:
        raise ValueError(f"target {target!r} in theme {theme!r} has several durations")
    return codes[0]["iso_code"]


def column_mapping(
    source_columns: DataFrame,
    targets: DataFrame,
    destination_columns: DataFrame,
    theme: str,
    target: str,
) -> DataFrame:
    """Source column name, destination column name and type for the columns of a target.

    ``data_type`` is taken from whichever of the two column tables carries it.
    """
    from_source = ["target_id", "dest_column_id", "source_name"]
    from_destination = ["dest_column_id", "dest_name"]
    typed_source = "data_type" in source_columns.columns
    if typed_source == ("data_type" in destination_columns.columns):
        raise ValueError("data_type must be in exactly one of the two column tables")
    (from_source if typed_source else from_destination).append("data_type")

    wanted = targets.where(is_target(theme, target)).select("target_id")
    return (
        source_columns.select(from_source)
        .join(wanted, "target_id")
        .join(destination_columns.select(from_destination), "dest_column_id")
        .select("source_name", "dest_name", "data_type")
    )


def destination_columns_of(
    source_columns: DataFrame,
    targets: DataFrame,
    destination_columns: DataFrame,
    theme: str,
    target: str,
) -> DataFrame:
    """Distinct destination column names of a target.

    A target may map many source columns to one id, so the ids are made distinct before
    the names are joined.
    """
    wanted = targets.where(is_target(theme, target)).select("target_id")
    used = distinct_keys(
        source_columns.select("target_id", "dest_column_id").join(wanted, "target_id"),
        "dest_column_id",
    )
    names = destination_columns.select("dest_column_id", "dest_name")
    return used.join(names, "dest_column_id").select("dest_name").distinct()


def destination_column_set(
    source_columns: DataFrame,
    targets: DataFrame,
    destination_columns: DataFrame,
    theme: str,
    target: str,
) -> set[str]:
    """``destination_columns_of`` as a Python set: the columns of one output file."""
    names = destination_columns_of(
        source_columns, targets, destination_columns, theme, target
    )
    return {row["dest_name"] for row in names.toLocalIterator()}


def value_targets(standard_values: DataFrame, destination_columns: DataFrame) -> DataFrame:
    """Canonical values with the name of the destination column they belong to."""
    names = destination_columns.select("dest_column_id", "dest_name")
    return (
        standard_values.select("dest_column_id", "target_value")
        .join(names, "dest_column_id")
        .select("dest_name", "target_value")
    )


def token_map(
    token_sources: DataFrame,
    token_destinations: DataFrame,
    token_extractions: DataFrame,
    extraction_name: str,
) -> DataFrame:
    """Destination column name behind each template token of an extraction.

    The name is null where a numbered column has no destination.
    """
    wanted = token_extractions.where(
        F.col("extraction_name") == F.lit(extraction_name)
    ).select("extraction_id", "extraction_name")
    return (
        token_sources.select("extraction_id", "dest_column_id", "column_number")
        .join(wanted, "extraction_id")
        .join(token_destinations.select("dest_column_id", "dest_name"), "dest_column_id", "left")
        .select(
            "dest_name",
            column_token(F.col("column_number"), F.col("extraction_name")).alias("token"),
        )
    )


CALENDAR_COLUMNS = (
    "target_id",
    "regulatory_flag",
    "day",
    "month",
    "weekday",
    "business_day_flag",
)


def regulatory_calendar(
    targets: DataFrame, publications: DataFrame, classifications: DataFrame
) -> DataFrame:
    """Publication days of regulated targets, followed by their whole classification row."""
    lowered = {name.lower() for name in CALENDAR_COLUMNS}
    repeated = [name for name in classifications.columns if name.lower() in lowered]
    if repeated:
        raise ValueError(f"classification columns repeat calendar columns: {repeated}")
    regulated = targets.where(flag_is_set(targets, "regulatory_flag")).select(
        "target_id", "regulatory_flag", "classification_id"
    )
    dates = publications.select("target_id", "day", "month", "weekday", "business_day_flag")
    return (
        dates.join(regulated, "target_id")
        .join(classifications, "classification_id")
        .select(*CALENDAR_COLUMNS, *[column(name) for name in classifications.columns])
    )
