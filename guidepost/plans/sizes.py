"""Size checks.

Spark broadcasts a side by itself when its file statistics or its finished shuffle are
small. It does not know the size of a JDBC table or of a filtered join, and then writes the
other side to the shuffle before it finds out. Where that other side is the bulk data, the
operators measure the small side first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column

MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Room that a field takes in a row besides its variable part.
FIELD_BYTES = 16

_VARIABLE_TYPES = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


def row_bytes(df: DataFrame, *names: str) -> Column:
    """Estimated bytes of a row of ``df``, or of the named columns of it."""
    size = F.lit(0).cast("long")
    for field in df.schema:
        if names and field.name not in names:
            continue
        size = size + FIELD_BYTES
        if isinstance(field.dataType, _VARIABLE_TYPES):
            text = column(field.name).cast("string")
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
    return size


def byte_total(df: DataFrame, *names: str, times: Column | int = 1) -> Column:
    """Aggregate over ``df``: estimated bytes of all rows, each counted ``times`` times."""
    return F.coalesce(F.sum(row_bytes(df, *names) * times), F.lit(0))


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` fits into ``max_bytes``, measured by one aggregate over it."""
    return df.agg(byte_total(df).alias("bytes")).first()["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if its measured size allows it, else return it unchanged.

    Without the mark Spark shuffles both sides, and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df


def shuffle_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Session settings that keep shuffle partitions near 128 MB for a known volume.

    Adaptive execution merges partitions that turn out small and splits skewed ones, so the
    number only has to be high enough.
    """
    target = 128 * 1024 * 1024
    partitions = max(cores, -(-shuffled_bytes // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(partitions),
    }
