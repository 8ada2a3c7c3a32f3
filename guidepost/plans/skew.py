from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guidepost.functions import column


def apart(*keys: str) -> Column:
    """Extra grouping column for an aggregate whose result is joined on ``keys``.

    It depends on the keys alone, so groups stay the same. Without it Spark joins straight on the
    aggregate's partitions, and adaptive execution only splits a hot key between two
    shuffles made for the join. With it the (already reduced) result is shuffled once more
    and a key that holds much of the other side is spread over many tasks.
    """
    return F.xxhash64(*[column(key) for key in keys]).alias("_apart")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key``, ready for a join on it that may meet hot keys."""
    return df.select(column(key), apart(key)).distinct().select(column(key))
