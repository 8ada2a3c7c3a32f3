"""Shape of the plans that Spark makes of the operators."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from guidepost import operators as ops
from guidepost.plans import (
    broadcast_if_small,
    byte_total,
    is_small,
    shuffle_settings,
    split_windows,
    width_for,
)
from guidepost.plans import ranges
from tests.helpers import plan_of, settings
from workload import roles
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_worker(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(queries()[name](spark, SF_DIR), "simple")
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "ArrowEval"):
        assert operator not in plan


def test_left_join_with_a_filter_on_its_right_is_an_inner_join(spark):
    found = ops.extractions_for_target(
        roles.line_extractions(spark, SF_DIR), roles.order_targets(spark, SF_DIR), "F"
    )
    plan = plan_of(found)
    assert "LeftOuter" not in plan
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(queries()["comparison_info"](spark, SF_DIR))
    assert "EqualTo(o_orderpriority,1-URGENT), EqualTo(o_orderstatus,F)" in plan


def test_size_check(spark):
    df = spark.createDataFrame([("abc", None), ("ñ", 10)], "a string, b int")
    # Bytes of text: 3 + 2, and 16 for each of four fields.
    assert df.agg(byte_total(df)).first()[0] == 5 + 4 * 16
    assert df.agg(byte_total(df, "b", times=3)).first()[0] == 2 * 16 * 3
    assert is_small(df, 69) and not is_small(df, 68)
    assert is_small(df.where("false"), 0)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        left = spark.range(5).withColumn("a", F.col("id").cast("string"))
        assert "BroadcastHashJoin" in plan_of(left.join(broadcast_if_small(df, 69), "a"))
        assert "SortMergeJoin" in plan_of(left.join(broadcast_if_small(df, 68), "a"))


def test_windows_never_become_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranges, "PIECES_AT_LEAST", 50)
    lengths = spark.sql(
        """SELECT timestamp_ntz'2024-01-01 00:00:00' AS s,
                  timestamp_ntz'2024-01-01 00:00:00'
                  + make_dt_interval(CAST(pow(2, id) AS INT)) AS e
           FROM range(22)"""
    )
    for days, width in ((1, 1), (4, 1), (16, 8), (128, 64), (1 << 13, 4096), (1 << 17, 32768)):
        df = lengths.where(f"e <= s + make_dt_interval({days}) AND e > s + make_dt_interval({days // 2})")
        df = df.crossJoin(spark.range(100))
        assert width_for(df, "s", "e") == width
        assert split_windows(df, "s", "e", width).count() <= 8 * 100 + 100
    # Few windows may become many pieces each.
    monkeypatch.undo()
    assert width_for(lengths.where("e < s + make_dt_interval(5000)"), "s", "e") == 1
    assert width_for(lengths.where("false"), "s", "e") == 1


def test_the_index_is_not_repeated_for_windows_of_unlike_lengths(spark, monkeypatch):
    """Windows of all lengths, some open, when nothing can be broadcast."""
    monkeypatch.setattr(ranges, "PIECES_AT_LEAST", 100)
    targets = spark.sql("SELECT 1 AS target_id, 'a' AS theme, 'x' AS target_name")
    start = "timestamp_ntz'2023-01-01 00:00:00' + make_dt_interval(id % 700)"
    windows = spark.range(300).selectExpr(
        "id AS extraction_id", "1 AS target_id", "'p' AS project", "'t' AS theme",
        "'n' AS extraction_name", f"{start} AS delta_start",
        f"""CASE WHEN id % 9 = 0 THEN timestamp_ntz'9999-12-31 00:00:00'
                 ELSE {start} + make_dt_interval(CAST(pow(3, id % 7) AS int)) END AS delta_end""",
    )
    index = spark.range(3000).selectExpr(
        "'p' AS project", "'t' AS theme", "'n' AS extraction_name", "concat('d', id) AS directory",
        "2023 + CAST(id % 2 AS int) AS year", "1 + CAST(id % 12 AS int) AS month",
        "1 + CAST(id % 28 AS int) AS day", "0 AS hour", "id",
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        paths = ops.resolve_paths(targets, windows, index, "a", "x", "window", max_broadcast_bytes=0)
        plan = plan_of(paths, "simple")
    of_index = plan[plan.index("SortMergeJoin") : plan.index("Range (0, 3000")]
    # One exchange merges repeated entries, one brings them to the join, which may split hot keys.
    assert "Generate" not in of_index and of_index.count("Exchange hashpartitioning") == 2
    assert plan.count("Generate explode") == 1
    expected = index.withColumn("at", F.expr("make_timestamp_ntz(year, month, day, hour, 0, 0)"))
    pairs = expected.join(windows, ["project"]).where("at BETWEEN delta_start AND delta_end")
    assert paths.count() == pairs.select("extraction_id", "directory").distinct().count() > 0


def test_shuffle_settings():
    tera = 1 << 40
    assert shuffle_settings(tera, 100)["spark.sql.shuffle.partitions"] == str(8192)
    assert shuffle_settings(0, 100)["spark.sql.shuffle.partitions"] == "100"
