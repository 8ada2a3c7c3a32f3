from collections import Counter

import pytest

from guidepost import operators as ops
from tests.helpers import rows

TARGETS = """target_id int, theme string, target_name string, select_template string,
    delta_value_start int, delta_value_end int, period_id int, period_interval int,
    dest_column_id int, version_column_id int, mandatory_data int, duration_id int,
    regulatory_flag {flag}, classification_id int"""


def targets(spark, flag="int"):
    yes, no = (True, False) if flag == "boolean" else (1, 0)
    return spark.createDataFrame(
        [
            (1, "a", "x", "t1", 0, 1, 1, 5, 10, 11, 1, 1, yes, 100),
            (2, "a", "y", "t2", 0, 1, 9, 5, 10, None, 0, 2, no, 100),
            (3, "b", "x", "t3", 0, 1, None, 5, 99, 10, 0, None, yes, 100),
            (4, "a'b", "x\"'", "t4", 0, 1, 1, 5, 10, 10, 0, 9, None, 100),
            (5, "twice", "z", "t5", 0, 1, 1, 5, 10, 10, 0, 1, yes, None),
            (5, "twice", "z", "t6", 0, 1, 1, 5, 10, 10, 0, 2, no, 100),
        ],
        TARGETS.format(flag=flag),
    )


@pytest.fixture
def columns(spark):
    return spark.createDataFrame(
        [(10, "key", "int"), (11, "version", "date"), (12, "other", "int"), (13, "key", "int")],
        "dest_column_id int, dest_name string, data_type string",
    )


@pytest.fixture
def source_columns(spark):
    return spark.createDataFrame(
        [(1, 10, "k"), (1, 10, "k2"), (1, 13, "k3"), (1, 77, "lost"), (2, 11, "v"), (5, 12, "o")],
        "target_id int, dest_column_id int, source_name string",
    )


@pytest.fixture
def periods(spark):
    return spark.createDataFrame([(1, "monthly")], "period_id int, period string")


@pytest.fixture
def durations(spark):
    return spark.createDataFrame(
        [(1, "P1D"), (2, "PT1H")], "duration_id int, iso_code string"
    )


def test_extractions_ignore_theme_unless_asked(spark):
    extractions = spark.createDataFrame(
        [(1, 1), (2, 1), (3, 2), (4, 3), (5, 5), (6, 42)], "extraction_id int, target_id int"
    ).selectExpr("*", "date'2024-01-01' as delta_start", "date'2024-01-02' as delta_end")

    def ids(*args):
        found = ops.extractions_for_target(extractions, targets(spark), *args)
        assert found.columns == ["extraction_id", "delta_start", "delta_end"]
        return sorted(r["extraction_id"] for r in found.collect())

    assert ids("x") == [1, 2, 4]
    assert ids("x", "a") == [1, 2]
    assert ids("z") == [5, 5], "a repeated target id repeats its extractions"
    assert ids("nothing") == []


def test_comparison_info_keeps_targets_without_matches(spark, periods, columns):
    def info(theme, target):
        return ops.comparison_info(targets(spark), periods, columns, theme, target)

    assert rows(info("a", "x")) == Counter(
        [(1, "a", "x", "t1", 0, 1, "monthly", 5, "key", 1, "version")]
    )
    assert rows(info("a", "y")) == Counter([(2, "a", "y", "t2", 0, 1, None, 5, "key", 0, None)])
    assert rows(info("b", "x")) == Counter([(3, "b", "x", "t3", 0, 1, None, 5, None, 0, "key")])


def test_quotes_in_values_are_plain_text(spark, periods, columns):
    found = ops.comparison_info(targets(spark), periods, columns, "a'b", "x\"'")
    assert [r["target_id"] for r in found.collect()] == [4]


def test_duration_code(spark, durations):
    def code(theme, target):
        return ops.target_duration_code(targets(spark), durations, theme, target)

    assert code("a", "x") == "P1D"
    assert code("b", "x") is None
    with pytest.raises(LookupError):
        code("a", "missing")
    with pytest.raises(ValueError, match="several"):
        code("twice", "z")


def test_column_mapping_takes_the_type_from_either_table(spark, source_columns, columns):
    expected = Counter([("k", "key", "int"), ("k2", "key", "int"), ("k3", "key", "int")])
    found = ops.column_mapping(source_columns, targets(spark), columns, "a", "x")
    assert rows(found) == expected

    typed = source_columns.selectExpr("*", "'int' as data_type")
    untyped = columns.drop("data_type")
    assert rows(ops.column_mapping(typed, targets(spark), untyped, "a", "x")) == expected
    with pytest.raises(ValueError, match="exactly one"):
        ops.column_mapping(typed, targets(spark), columns, "a", "x")
    with pytest.raises(ValueError, match="exactly one"):
        ops.column_mapping(source_columns, targets(spark), untyped, "a", "x")


def test_destination_columns_are_distinct_by_name(spark, source_columns, columns):
    args = (source_columns, targets(spark), columns, "a", "x")
    assert rows(ops.destination_columns_of(*args)) == Counter([("key",)])
    assert ops.destination_column_set(*args) == {"key"}


def test_value_targets_keep_duplicates(spark, columns):
    values = spark.createDataFrame(
        [(10, "A"), (10, "A"), (11, "B"), (99, "C")], "dest_column_id int, target_value string"
    )
    assert rows(ops.value_targets(values, columns)) == Counter(
        {("key", "A"): 2, ("version", "B"): 1}
    )


def test_token_map(spark, columns):
    sources = spark.createDataFrame(
        [(1, 10, 1), (1, 55, 2), (1, 11, None), (2, 10, 1)],
        "extraction_id int, dest_column_id int, column_number int",
    )
    extractions = spark.createDataFrame(
        [(1, "daily"), (2, "other")], "extraction_id int, extraction_name string"
    )
    assert rows(ops.token_map(sources, columns, extractions, "daily")) == Counter(
        [("key", "<<Columna_1_daily>>"), (None, "<<Columna_2_daily>>"), ("version", None)]
    )


@pytest.mark.parametrize("flag", ["int", "boolean", "string"])
def test_calendar_reads_any_flag_type(spark, flag):
    source = targets(spark, "int" if flag == "string" else flag)
    if flag == "string":
        source = source.withColumn("regulatory_flag", source.regulatory_flag.cast("string"))
    publications = spark.createDataFrame(
        [(1, 5, 1, 2, True), (1, 6, 1, 3, True), (2, 7, 1, 4, True), (5, 8, 1, 0, False)],
        "target_id int, day int, month int, weekday int, business_day_flag boolean",
    )
    classes = spark.createDataFrame([(100, "law")], "classification_id int, title string")
    found = ops.regulatory_calendar(source, publications, classes)
    assert found.columns[6:] == ["classification_id", "title"]
    assert sorted((r["target_id"], r["day"], r["title"]) for r in found.collect()) == [
        (1, 5, "law"),
        (1, 6, "law"),
    ]


def test_calendar_rejects_repeated_names(spark):
    classes = spark.createDataFrame([(100, 1)], "classification_id int, Month int")
    with pytest.raises(ValueError, match="Month"):
        ops.regulatory_calendar(targets(spark), classes, classes)
