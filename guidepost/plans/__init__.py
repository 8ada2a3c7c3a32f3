"""Join helpers: measured broadcast, hot keys, and time windows as equal keys."""

from guidepost.plans.ranges import bucket_times, hold_time, split_windows, steps, width_for
from guidepost.plans.sizes import (
    MAX_BROADCAST_BYTES,
    broadcast_if_small,
    byte_total,
    is_small,
    shuffle_settings,
)
from guidepost.plans.skew import apart, distinct_keys

__all__ = [
    "MAX_BROADCAST_BYTES",
    "apart",
    "broadcast_if_small",
    "bucket_times",
    "byte_total",
    "distinct_keys",
    "hold_time",
    "is_small",
    "shuffle_settings",
    "split_windows",
    "steps",
    "width_for",
]
