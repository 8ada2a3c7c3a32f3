from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from guidepost import operators
from guidepost.sources import (
    CONTROL_TABLES,
    SOURCE_NAMES,
    ControlTable,
    JdbcSource,
    ParquetSource,
    load_catalog,
    new_scratch_path,
    open_catalog,
    store_catalog,
)


class ControlTables:
    """The operators bound to a set of control tables.

    ``tables`` maps the roles of ``CONTROL_TABLES`` to DataFrames; only the roles that a
    method uses have to be there.
    """

    def __init__(self, tables: Mapping[str, DataFrame]) -> None:
        self.tables = dict(tables)

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        sources: Mapping[str, ParquetSource | JdbcSource],
        more_tables: Mapping[str, ControlTable] | None = None,
        more_names: Mapping[str, str] | None = None,
    ) -> ControlTables:
        """The control tables from their sources.

        ``more_tables`` adds roles that the control databases do not name themselves, such as
        ``quality_rules``; ``more_names`` renames further columns.
        """
        tables = CONTROL_TABLES | dict(more_tables or {})
        return cls(load_catalog(spark, sources, tables, SOURCE_NAMES | dict(more_names or {})))

    def stored(self, path: str | None = None) -> ControlTables:
        """These tables as they are now, stored below ``path`` (or as intermediate tables): however
        the sources change, all lookups of the result agree. ``open`` gets them back."""
        spark = next(iter(self.tables.values())).sparkSession
        return ControlTables(store_catalog(self.tables, path or new_scratch_path(spark, "catalog")))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> ControlTables:
        """The tables that ``stored`` left below ``path``."""
        return cls(open_catalog(spark, path))

    def __getitem__(self, role: str) -> DataFrame:
        return self.tables[role]

    def extractions_for_target(self, target: str, theme: str | None = None) -> DataFrame:
        return operators.extractions_for_target(
            self["extractions"], self["targets"], target, theme
        )

    def comparison_info(self, theme: str, target: str) -> DataFrame:
        return operators.comparison_info(
            self["targets"], self["periods"], self["destination_columns"], theme, target
        )

    def target_duration_code(self, theme: str, target: str) -> str | None:
        return operators.target_duration_code(
            self["targets"], self["durations"], theme, target
        )

    def resolve_paths(self, theme: str, target: str, mode: str = "flag") -> DataFrame:
        return operators.resolve_paths(
            self["targets"], self["extractions"], self["partition_index"], theme, target, mode
        )

    def column_mapping(self, theme: str, target: str) -> DataFrame:
        return operators.column_mapping(
            self["source_columns"],
            self["targets"],
            self["destination_columns"],
            theme,
            target,
        )

    def destination_column_set(self, theme: str, target: str) -> set[str]:
        return operators.destination_column_set(
            self["source_columns"],
            self["targets"],
            self["destination_columns"],
            theme,
            target,
        )

    def value_targets(self) -> DataFrame:
        return operators.value_targets(self["standard_values"], self["destination_columns"])

    def token_map(self, extraction_name: str) -> DataFrame:
        return operators.token_map(
            self["token_sources"],
            self["token_destinations"],
            self["token_extractions"],
            extraction_name,
        )

    def regulatory_calendar(self) -> DataFrame:
        return operators.regulatory_calendar(
            self["targets"], self["publications"], self["classifications"]
        )

    def quality_criteria(self, theme: str, target: str) -> DataFrame:
        """Needs a ``quality_rules`` table: theme, target_name and the ten rule columns."""
        return operators.quality_criteria(self["quality_rules"], theme, target)

    def evaluate_quality(
        self, df: DataFrame, theme: str, target: str, as_of: dt.date | str
    ) -> DataFrame:
        return operators.evaluate_quality(df, self.quality_criteria(theme, target), as_of)

    def advance_deltas(self, ids: DataFrame, key: str = "extraction_id") -> DataFrame:
        return operators.advance_deltas(self["extractions"], ids, key)

    def advance_target_deltas(self, ids: DataFrame) -> DataFrame:
        """The targets with their own delta values moved on."""
        return operators.advance_deltas(
            self["targets"], ids, "target_id", "delta_value_start", "delta_value_end"
        )
