"""Time windows as equal keys.

"Time between start and end" alone gives Spark nothing to hash on: for one busy key it would
compare every time with every window. Here the day axis is cut into buckets of one width; a time
falls into one of them and a window becomes those it touches, so bucket numbers join by
equality and only times near a window are compared. Times are never repeated, windows are.

The width is the least one for which all windows together become a bounded number of pieces, after they
are cut to the span of the times (an open end would otherwise touch millions of buckets). A
wider one than the least is only taken if the windows are longer than that on average, so
what is compared beyond the result is at most about twice the result, for times that lie evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guidepost.functions import column

# Bucket widths in days.
WIDTHS = (1, 8, 64, 512, 4096, 32768)
# Pieces that windows may become: so many each on average, and so many altogether in any case.
PIECES_EACH = 8
PIECES_AT_LEAST = 1 << 16


def _day_number(time: Column) -> Column:
    return F.unix_date(F.to_date(time))


def _bucket(time: Column, width: int) -> Column:
    return F.floor(_day_number(time) / width)


def hold_time(df: DataFrame, start: str, end: str) -> DataFrame:
    """``df`` without the windows that hold no time (a null bound, or the end before the start)."""
    return df.where(column(start) <= column(end))


def steps(start: str, end: str, width: int) -> Column:
    """Buckets of ``width`` that a window touches."""
    return _bucket(column(end), width) - _bucket(column(start), width) + 1


def width_for(df: DataFrame, start: str, end: str) -> int:
    """The width of the buckets for the windows of ``df``; one aggregate over them.

    The last one is taken if none gives few enough pieces, which are one or two a window below 89 years.
    """
    told = df.agg(
        F.count(F.lit(1)).alias("windows"),
        *[F.sum(steps(start, end, width)).alias(f"steps_{width}") for width in WIDTHS],
    ).first()
    most = max(PIECES_EACH * told["windows"], PIECES_AT_LEAST)
    fits = (width for width in WIDTHS if (told[f"steps_{width}"] or 0) <= most)
    return next(fits, WIDTHS[-1])


def split_windows(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """One row for each bucket that a window touches, in ``bucket``."""
    touched = F.sequence(_bucket(column(start), width), _bucket(column(end), width))
    return df.withColumn("bucket", F.explode(touched))


def bucket_times(df: DataFrame, time: str, width: int) -> DataFrame:
    """The rows of ``df`` with the bucket their time falls into."""
    return df.withColumn("bucket", _bucket(column(time), width))
