from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The placeholder format that templates in the control tables use.
TOKEN_PREFIX = "<<Columna_"
TOKEN_SUFFIX = ">>"
TOKEN_PATTERN = "<<Columna_[0-9]+_.+?>>"

INTEGER_TYPES = {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"}
# Text that a strict cast to a whole number accepts, as far as it is in range.
INTEGER_TEXT = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"


def column(name: str) -> Column:
    """The column of exactly this name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cast_or_null(df: DataFrame, name: str, data_type: str) -> Column:
    """A column of ``df`` as another type, null where the value does not fit.

    A strict cast throws for every bad text, and catching that costs far more than the cast.
    Text that is no whole number is the usual case, so a pattern sorts it out first.
    """
    value = column(name)
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    if is_text and data_type.strip().lower() in INTEGER_TYPES:
        value = F.when(value.rlike(INTEGER_TEXT), value)
    return value.try_cast(data_type)


def canonical_text(value: Column) -> Column:
    """Form in which two spellings of one value compare equal: trimmed, lower case."""
    return F.lower(F.trim(value))


def column_token(number: Column, extraction_name: Column) -> Column:
    """Placeholder of the numbered column of an extraction; null if a part is null."""
    return F.concat(
        F.lit(TOKEN_PREFIX),
        number.cast("string"),
        F.lit("_"),
        extraction_name,
        F.lit(TOKEN_SUFFIX),
    )


def flag_is_set(df: DataFrame, name: str) -> Column:
    """Whether a flag column holds true or 1, whichever type the source gave it.

    Comparing a boolean with 1 fails under ANSI mode, so the type decides.
    """
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return column(name)
    return cast_or_null(df, name, "int") == 1


def partition_time(df: DataFrame, like: T.DataType) -> Column:
    """Start of the hour named by the year, month, day and hour columns of ``df``.

    An impossible date gives null. ``like`` is the type the result is compared with:
    time-zone-free when that is, otherwise in the session's zone.
    """
    make = (
        F.try_make_timestamp_ntz
        if isinstance(like, T.TimestampNTZType)
        else F.try_make_timestamp
    )
    zero = F.lit(0)
    parts = [cast_or_null(df, name, "int") for name in ("year", "month", "day", "hour")]
    return make(*parts, zero, zero)
