"""Column expressions shared by the operators; all of them stay inside the JVM."""

from guidepost.functions.columns import (
    TOKEN_PATTERN,
    canonical_text,
    cast_or_null,
    column,
    column_token,
    flag_is_set,
    free_name,
    partition_time,
)

__all__ = [
    "TOKEN_PATTERN",
    "canonical_text",
    "cast_or_null",
    "column",
    "column_token",
    "flag_is_set",
    "free_name",
    "partition_time",
]
