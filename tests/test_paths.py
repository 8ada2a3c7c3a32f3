import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from guidepost import operators as ops
from tests.helpers import SMALL_LIMITS, final_plan_of, plan_of, rows, settings

KEYS = ("p", "t", "n")
INDEX = """project string, theme string, extraction_name string, directory string,
    year int, month int, day int, hour int, delta_flag {flag}"""
EXTRACTIONS = """extraction_id int, target_id int, project string, theme string,
    extraction_name string, delta_start {time}, delta_end {time}"""
# Zero makes every size check fail, so that the shuffled way is taken.
LIMITS = pytest.mark.parametrize("limit", [64 << 20, 0])


@pytest.fixture
def targets(spark):
    return spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (2, "a", "y")],
        "target_id int, theme string, target_name string",
    )


def extractions(spark, windows, time="timestamp_ntz"):
    return spark.createDataFrame(
        [(i, target, *KEYS, start, end) for i, (target, start, end) in enumerate(windows)],
        EXTRACTIONS.format(time=time),
    )


def index(spark, entries, flag="int"):
    return spark.createDataFrame(
        [(*KEYS, directory, *parts, is_set) for directory, parts, is_set in entries],
        INDEX.format(flag=flag),
    )


def found(df):
    return sorted((r["extraction_id"], r["directory"]) for r in df.collect())


@LIMITS
@pytest.mark.parametrize("time", ["timestamp_ntz", "timestamp"])
def test_window_ends_count_and_bad_dates_do_not(spark, targets, limit, time):
    day = dt.datetime(2024, 1, 31)
    windows = [
        (1, day.replace(hour=22), dt.datetime(2024, 2, 1, 1)),
        (1, day.replace(hour=22, minute=1), day.replace(hour=23)),
        (1, day, None),
        (1, day.replace(hour=23), day.replace(hour=22)),
        (2, day, day.replace(hour=23)),
    ]
    entries = [
        ("d21", (2024, 1, 31, 21), 1),
        ("d22", (2024, 1, 31, 22), 1),
        ("d23", (2024, 1, 31, 23), 0),
        ("d23", (2024, 1, 31, 23), 1),
        ("d25", (2024, 2, 1, 1), None),
        ("d26", (2024, 2, 1, 2), 1),
        ("bad", (2024, 13, 1, 0), 1),
        ("bad", (2024, 2, 30, 0), 1),
        ("bad", (2024, 1, 31, None), 1),
    ]
    paths = ops.resolve_paths(
        targets,
        extractions(spark, windows, time),
        index(spark, entries),
        "a",
        "x",
        "window",
        limit,
    )
    assert paths.columns == [
        "extraction_id",
        "directory",
        "extraction_name",
        "target_id",
        "delta_start",
        "delta_end",
    ]
    assert found(paths) == [(0, "d22"), (0, "d23"), (0, "d25"), (1, "d23")]


@LIMITS
def test_windows_of_any_length(spark, targets, limit):
    """From one hour to open ended, before 1970 and beyond; each takes its own width."""
    windows = [
        (1, dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31)),
        (1, dt.datetime(2020, 1, 1), dt.datetime(9999, 12, 31)),
        (1, dt.datetime(1960, 5, 5, 4), dt.datetime(1960, 5, 5, 4)),
        (1, dt.datetime(1969, 12, 1), dt.datetime(1970, 1, 3)),
        (1, dt.datetime(2019, 1, 1), dt.datetime(2021, 1, 1)),
    ]
    entries = [
        (str(year), (year, month, day, hour), 0)
        for year, month, day, hour in [
            (1960, 5, 5, 4),
            (1960, 5, 5, 5),
            (1969, 12, 31, 23),
            (1970, 1, 3, 0),
            (1970, 1, 3, 1),
            (2019, 12, 31, 23),
            (2020, 1, 1, 0),
            (2021, 1, 1, 0),
            (2100, 1, 1, 0),
        ]
    ]
    paths = ops.resolve_paths(
        targets, extractions(spark, windows), index(spark, entries), "a", "x", "window", limit
    )
    expected = {
        (i, name)
        for i, (_, start, end) in enumerate(windows)
        for name, parts, _ in entries
        if start <= dt.datetime(*parts) <= end
    }
    assert set(found(paths)) == expected


@LIMITS
def test_windows_equal_brute_force(spark, limit):
    """Random windows and entries; one target and one key triple hold a third of them."""
    rng = random.Random(7)
    origin = dt.datetime(2023, 1, 1)

    def key():
        return "hot" if rng.random() < 0.34 else f"k{rng.randrange(6)}"

    def target():
        return 0 if rng.random() < 0.34 else rng.randrange(20)

    extraction_rows = []
    for i in range(300):
        start = origin + dt.timedelta(minutes=rng.randrange(500_000))
        length = rng.choice([0, 59, 600, 5_000, 100_000, 2_000_000])
        end = start + dt.timedelta(minutes=length)
        extraction_rows.append((i, target(), key(), "t", "n", start, end))
    extraction_rows += [extraction_rows[0]] * 100
    index_rows = []
    for i in range(2_000):
        at = origin + dt.timedelta(hours=rng.randrange(12_000))
        parts = (at.year, at.month, at.day, at.hour)
        index_rows.append((key(), "t", "n", f"dir{i % 700}", *parts, i % 2))
    index_rows += [index_rows[0]] * 500
    target_rows = [(i, "a" if i % 4 else "b", "x") for i in range(20)]

    chosen = {t for t, theme, _ in target_rows if theme == "a"}
    expected = Counter(
        {
            (e[0], x[3], e[4], e[1], e[5], e[6])
            for e in extraction_rows
            for x in index_rows
            if e[1] in chosen and e[2] == x[0] and e[5] <= dt.datetime(*x[4:8]) <= e[6]
        }
    )
    frames = (
        spark.createDataFrame(target_rows, "target_id int, theme string, target_name string"),
        spark.createDataFrame(extraction_rows, EXTRACTIONS.format(time="timestamp_ntz")),
        spark.createDataFrame(index_rows, INDEX.format(flag="int")),
    )
    paths = ops.resolve_paths(*frames, "a", mode="window", max_broadcast_bytes=limit)
    assert rows(paths) == expected
    assert len(expected) > 1_000


@LIMITS
@pytest.mark.parametrize("flag", ["int", "boolean"])
def test_flag_mode_reads_any_time(spark, targets, limit, flag):
    yes, no = (True, False) if flag == "boolean" else (1, 0)
    entries = [
        ("d1", (1999, 1, 1, 0), yes),
        ("d1", (2024, 1, 1, 0), yes),
        ("d2", (2024, 1, 1, 0), no),
        ("d3", (2024, 1, 1, 0), None),
        ("d4", (2024, 99, 1, 0), yes),
    ]
    now = dt.datetime(2024, 1, 1)
    paths = ops.resolve_paths(
        targets,
        extractions(spark, [(1, now, now), (2, now, now)]),
        index(spark, entries, flag),
        "a",
        "x",
        max_broadcast_bytes=limit,
    )
    assert found(paths) == [(0, "d1"), (0, "d4")]


@LIMITS
@pytest.mark.parametrize("mode", ["window", "flag"])
def test_no_extraction_gives_no_path(spark, targets, limit, mode):
    paths = ops.resolve_paths(
        targets,
        extractions(spark, []),
        index(spark, [("d", (2024, 1, 1, 0), 1)]),
        "a",
        "x",
        mode,
        limit,
    )
    assert found(paths) == []


def test_unknown_mode_is_an_error(spark, targets):
    with pytest.raises(ValueError, match="mode"):
        ops.resolve_paths(targets, targets, targets, mode="pdf")


def big_inputs(spark):
    """A third of the extractions belong to one target, a third of the index to one key."""
    targets = spark.range(2_000).selectExpr(
        "id as target_id", "'a' as theme", "'x' as target_name"
    )
    extractions = spark.range(0, 30_000, 1, 8).selectExpr(
        "id as extraction_id",
        "if(id % 3 = 0, 7, id % 2000) as target_id",
        "if(id % 300 = 0, 'hot', concat('p', id % 997)) as project",
        "'t' as theme",
        "'n' as extraction_name",
        "timestamp_ntz'2024-01-01 00:00:00' as delta_start",
        "timestamp_ntz'2024-01-01 05:00:00' as delta_end",
    )
    index = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('p', id % 997)) as project",
        "'t' as theme",
        "'n' as extraction_name",
        "concat('dir', id) as directory",
        "2024 as year",
        "1 as month",
        "1 as day",
        "cast(id % 24 as int) as hour",
        "1 as delta_flag",
    )
    return targets, extractions, index


@pytest.mark.parametrize("mode", ["window", "flag"])
def test_small_windows_are_broadcast_and_one_exchange_merges_repeats(spark, tmp_path, mode):
    targets, extractions, index = big_inputs(spark)
    index.write.parquet(f"{tmp_path}/index")
    stored = spark.read.parquet(f"{tmp_path}/index")
    few = targets.where("target_id = 11")
    with settings(spark, **SMALL_LIMITS):
        plan = plan_of(ops.resolve_paths(few, extractions, stored, mode=mode), "simple")
    assert "SortMergeJoin" not in plan
    # The windows make theirs distinct below the broadcast; the index has a single exchange.
    assert plan.split("BroadcastExchange")[0].count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_years_of_the_windows_bound_the_scan_of_the_index(spark, tmp_path):
    targets, extractions, index = big_inputs(spark)
    index.withColumn("year", F.expr("if(extraction_name = 'n', year, 1999)")).write.parquet(
        f"{tmp_path}/index"
    )
    stored = spark.read.parquet(f"{tmp_path}/index")
    found = ops.resolve_paths(targets, extractions, stored, "a", "x", "window")
    plan = plan_of(found)
    assert "GreaterThanOrEqual(year,2024)" in plan and "LessThanOrEqual(year,2024)" in plan
    expected = ops.resolve_paths(targets, extractions, index, "a", "x", "window")
    assert found.count() == expected.count() > 0


def test_hot_keys_are_split_when_nothing_can_be_broadcast(spark):
    targets, extractions, index = big_inputs(spark)
    with settings(spark, **SMALL_LIMITS):
        windows = ops.extraction_windows(targets, extractions, "a", "x")
        assert "SortMergeJoin(skew=true)" in final_plan_of(windows)
        assert windows.count() == 30_000
        paths = ops.resolve_paths(
            targets, extractions, index, "a", "x", "window", max_broadcast_bytes=0
        )
        plan = final_plan_of(paths)
        assert "SortMergeJoin(skew=true)" in plan
    expected = ops.resolve_paths(targets, extractions, index, "a", "x", "window")
    assert paths.count() == expected.count() > 0
