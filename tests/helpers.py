import contextlib
import io
from collections import Counter


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def final_plan_of(df):
    """The plan that adaptive execution ended with."""
    df.collect()
    return plan_of(df, "simple").split("== Initial Plan ==")[0]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@contextlib.contextmanager
def settings(spark, **values):
    """Session settings for a block; double underscores stand for dots."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Makes small test data meet the limits that cluster data meets: nothing is broadcast by
# Spark itself, and a partition of some kilobytes counts as skewed.
SMALL_LIMITS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "10KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "5KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}
