"""The operators: plain functions from DataFrames to a DataFrame."""

from guidepost.operators.deltas import advance_deltas, advance_published, publish_windows
from guidepost.operators.lake import read_resolved
from guidepost.operators.lookups import (
    column_mapping,
    comparison_info,
    destination_column_set,
    destination_columns_of,
    extractions_for_target,
    regulatory_calendar,
    target_duration,
    target_duration_code,
    token_map,
    value_targets,
)
from guidepost.operators.paths import extraction_windows, resolve_paths
from guidepost.operators.quality import evaluate_quality, quality_criteria, valid_rules
from guidepost.operators.standardize import (
    absent_columns,
    apply_column_mapping,
    count_bad_casts,
    standardize_values,
)
from guidepost.operators.templates import render_templates

__all__ = [
    "absent_columns",
    "advance_deltas",
    "advance_published",
    "apply_column_mapping",
    "column_mapping",
    "comparison_info",
    "count_bad_casts",
    "destination_column_set",
    "destination_columns_of",
    "evaluate_quality",
    "extraction_windows",
    "extractions_for_target",
    "publish_windows",
    "quality_criteria",
    "read_resolved",
    "regulatory_calendar",
    "render_templates",
    "resolve_paths",
    "standardize_values",
    "target_duration",
    "target_duration_code",
    "token_map",
    "valid_rules",
    "value_targets",
]
