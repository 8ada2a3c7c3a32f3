"""Operators that work on data: column and value standards, templates, quality, deltas."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from guidepost import operators as ops
from guidepost.functions import cast_or_null
from guidepost.operators import quality
from tests.helpers import SMALL_LIMITS, final_plan_of, plan_of, rows, settings

MAPPING = "source_name string, dest_name string, data_type string"
VALUES = "dest_name string, target_value string"


def test_column_mapping_renames_casts_and_drops_the_rest(spark):
    data = spark.createDataFrame(
        [("1", "2.345", "x"), ("one", None, "y"), ("99999999999", "7", None)],
        "`a.b` string, n string, rest string",
    )
    mapping = spark.createDataFrame(
        [
            ("n", "amount", "decimal(9,2)"),
            ("a.b", "id", "whole number"),
            ("a.b", "id text", "string"),
            ("a.b", "id text", "string"),
        ],
        MAPPING,
    )
    types = {"whole number": "int"}
    found = ops.apply_column_mapping(data, mapping, types)
    assert found.columns == ["id", "id text", "amount"]
    assert rows(found) == Counter(
        [
            (1, "1", Decimal("2.35")),
            (None, "one", None),
            (None, "99999999999", Decimal("7.00")),
        ]
    )
    assert rows(ops.count_bad_casts(data, mapping, types)) == Counter(
        [("id", 2), ("id text", 0), ("amount", 0)]
    )


def test_bad_casts_are_counted_while_writing(spark, tmp_path):
    values = [(str(i) if i % 3 else f"x{i}", None if i % 5 else "1.x") for i in range(60)]
    data, seen = seen_rows(spark, values, "a string, b string")
    entries = [("a", "n", "int"), ("b", "amount", "decimal(9,2)"), ("a", "text", "string")]
    mapping = spark.createDataFrame(entries, MAPPING)
    observed = Observation()
    found = ops.apply_column_mapping(data, mapping, bad_casts=observed)
    found.write.parquet(f"{tmp_path}/t")
    assert seen.value == 60
    assert observed.get == {"n": 20, "amount": 12, "text": 0}
    counted = {r["dest_name"]: r["bad_casts"] for r in ops.count_bad_casts(data, mapping).collect()}
    assert counted == observed.get
    with pytest.raises(ValueError, match="no column"):
        ops.apply_column_mapping(data, mapping.where("false"), bad_casts=Observation())


def test_whole_number_pattern_agrees_with_the_cast(spark):
    texts = ["1", " 2\t", "+3", "-4\n", "5.0", "6e1", "", " ", "+", "- 7", "x8", "9 9", None]
    texts += ["٣", "\x001", "2147483648", "-99999999999999999999", "0x10", "1L", "１", "\x7f7"]
    data = spark.createDataFrame([(text,) for text in texts], "v string")
    for data_type in ("tinyint", "INT", " bigint "):
        both = data.select(
            "v",
            F.col("v").try_cast(data_type.strip()).alias("plain"),
            cast_or_null(data, "v", data_type).alias("checked"),
        )
        assert both.where("plain IS DISTINCT FROM checked").collect() == []


def test_column_mapping_errors(spark):
    data = spark.createDataFrame([(1, 2)], "a int, b int")

    def apply(*mapping):
        return ops.apply_column_mapping(data, spark.createDataFrame(list(mapping), MAPPING))

    with pytest.raises(ValueError, match="not in the data.*'c'"):
        apply(("a", "x", "int"), ("c", "y", "int"))
    with pytest.raises(ValueError, match="several types.*'x'"):
        apply(("a", "x", "int"), ("b", "x", "string"))
    with pytest.raises(ValueError, match="absent"):
        ops.apply_column_mapping(data, spark.createDataFrame([], MAPPING), absent="ignore")


def test_several_sources_absent_sources_and_letter_case(spark):
    data = spark.createDataFrame([(None, "1", "x"), ("7", "2", "y"), ("no", "3", "z")],
                                 "b string, A string, c string")
    mapping = spark.createDataFrame(
        [("a", "n", "int"), ("B", "n", "int"), ("C", "c", "string"), ("gone", "n", "int"),
         ("lost", "m", "int")],
        MAPPING,
    )
    found = ops.apply_column_mapping(data, mapping, absent="skip")
    assert found.columns == ["n", "c"]
    assert rows(found) == Counter([(1, "x"), (7, "y"), (3, "z")])
    assert rows(ops.count_bad_casts(data, mapping, absent="skip")) == Counter([("n", 1), ("c", 0)])
    assert rows(ops.absent_columns(data, mapping)) == Counter([("gone",), ("lost",)])
    with pytest.raises(ValueError, match="not in the data.*'gone', 'lost'"):
        ops.apply_column_mapping(data, mapping)
    with settings(spark, spark__sql__caseSensitive="true"):
        exact = ops.apply_column_mapping(data, mapping.where("dest_name = 'n'"), absent="skip")
        assert exact.columns == []


def test_a_mapping_may_have_many_columns(spark):
    data = spark.range(2).selectExpr("id", *[f"id + {i} AS c{i}" for i in range(300)])
    mapping = spark.createDataFrame([(f"c{i}", f"d{i}", "int") for i in range(300)], MAPPING)
    assert ops.apply_column_mapping(data, mapping).columns == [f"d{i}" for i in range(300)]


def test_values_match_whatever_the_case_of_the_column_and_helper_names(spark):
    data = spark.createDataFrame([(" red ", "s", "c")], "Colour string, spelling string, canonical string")
    targets = spark.createDataFrame([("COLOUR", "Red"), ("spelling", "S")], VALUES)
    assert rows(ops.standardize_values(data, targets)) == Counter([("Red", "S", "c")])


def test_standards_that_are_used_are_broadcast_if_few(spark):
    data = spark.range(3000).selectExpr("id", "concat('v', id % 3) as v")
    many = spark.range(50_000).selectExpr("'v' as dest_name", "concat('V', id) as target_value")
    with settings(spark, **SMALL_LIMITS):
        found = ops.standardize_values(data, many, max_broadcast_bytes=2000)
        assert "SortMergeJoin" not in plan_of(found)
    assert rows(found.select("v").distinct()) == Counter([("V0",), ("V1",), ("V2",)])


def test_mapping_needs_no_shuffle_and_reads_only_its_columns(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    mapping = spark.createDataFrame([("o_totalprice", "price", "decimal(18,2)")], MAPPING)
    plan = plan_of(ops.apply_column_mapping(orders, mapping))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<o_totalprice:double>" in plan


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_values_match_without_blanks_and_capitals(spark, limit):
    data = spark.createDataFrame(
        [(1, " red ", "x"), (2, "RED", None), (3, "green", "X"), (4, None, "y"), (1, " red ", "x")],
        "id int, colour string, mark string",
    )
    targets = spark.createDataFrame(
        [
            ("colour", "Red"),
            ("colour", "rED "),
            ("colour", None),
            ("mark", "X!"),
            ("mark", "Y"),
            ("absent", "x"),
        ],
        VALUES,
    )
    found = ops.standardize_values(data, targets, limit)
    assert found.columns == data.columns
    assert rows(found) == Counter(
        {
            (1, "Red", "x"): 2,
            (2, "Red", None): 1,
            (3, "green", "X"): 1,
            (4, None, "Y"): 1,
        }
    )


def test_values_of_other_types_are_an_error(spark):
    targets = spark.createDataFrame([("id", "1")], VALUES)
    with pytest.raises(ValueError, match="id"):
        ops.standardize_values(spark.range(3), targets)


def test_no_targets_leaves_the_data_alone(spark):
    data = spark.range(3)
    assert ops.standardize_values(data, spark.createDataFrame([], VALUES)).columns == ["id"]


def test_small_value_targets_leave_the_data_unshuffled(spark):
    data = spark.range(10_000).selectExpr("id", "if(id % 3 = 0, 'a', concat('v', id)) as v")
    targets = data.selectExpr("'v' as dest_name", "upper(v) as target_value")
    with settings(spark, **SMALL_LIMITS):
        small = ops.standardize_values(data, targets)
        assert "SortMergeJoin" not in plan_of(small)
        large = ops.standardize_values(data, targets, max_broadcast_bytes=0)
        assert "SortMergeJoin(skew=true)" in final_plan_of(large)
    assert rows(small) == rows(large) == rows(data.selectExpr("id", "upper(v)"))


TEMPLATES = [
    (1, "select <<Columna_1_x>>, <<Columna_2_x>> from <<Columna_1_x>>"),
    (2, "<<Columna_3_x>>"),
    (3, "no token << Columna_1_x >>"),
    (4, None),
    (5, ""),
    (6, "<<Columna_9_x>> <<Columna_1_x>><<Columna_8_x>><<Columna_9_x>>"),
    (7, "<<Columna_4_x>>"),
    (1, "select <<Columna_1_x>>, <<Columna_2_x>> from <<Columna_1_x>>"),
]
TOKENS = [
    ("one", "<<Columna_1_x>>"),
    ("two$1\\", "<<Columna_2_x>>"),
    (None, "<<Columna_3_x>>"),
    ("four", "<<Columna_4_x>>"),
    ("FOUR", "<<Columna_4_x>>"),
    ("<<Columna_1_x>>", "<<Columna_8_x>>"),
    ("none", None),
]


def test_templates(spark):
    templates = spark.createDataFrame(TEMPLATES, "id int, select_template string")
    tokens = spark.createDataFrame(TOKENS, "dest_name string, token string")
    found = ops.render_templates(templates, tokens)
    assert found.columns == ["id", "select_template", "rendered", "unresolved"]
    expected = {
        1: ("select one, two$1\\ from one", []),
        2: ("<<Columna_3_x>>", ["<<Columna_3_x>>"]),
        3: ("no token << Columna_1_x >>", []),
        4: (None, None),
        5: ("", []),
        6: (
            "<<Columna_9_x>> one<<Columna_1_x>><<Columna_9_x>>",
            ["<<Columna_9_x>>"],
        ),
        7: ("FOUR", []),
    }
    collected = found.collect()
    assert len(collected) == len(TEMPLATES)
    for row in collected:
        assert (row["rendered"], row["unresolved"]) == expected[row["id"]]


def test_hot_templates_and_tokens_are_split(spark):
    """A third of the templates share one text; token 0 is in all others."""
    templates = spark.range(0, 30_000, 1, 8).selectExpr(
        "id",
        """if(id % 3 = 0, '<<Columna_1_x>>',
              concat('<<Columna_0_x>> <<Columna_', id, '_x>>')) as select_template""",
        "sha2(string(id), 256) as payload",
    )
    tokens = spark.range(30_000).selectExpr(
        "concat('c', id) as dest_name", "concat('<<Columna_', id, '_x>>') as token"
    )
    with settings(spark, **SMALL_LIMITS):
        rendered = ops.render_templates(templates, tokens, max_broadcast_bytes=0)
        assert final_plan_of(rendered).count("SortMergeJoin(skew=true)") == 1
        few = ops.render_templates(templates, tokens)
        assert "SortMergeJoin" not in plan_of(few) and "Exchange hash" not in plan_of(few)
        assert rows(few.select("id", "rendered")) == rows(rendered.select("id", "rendered"))
    expected = templates.selectExpr(
        "id", "if(id % 3 = 0, 'c1', concat('c0 c', id)) as rendered"
    )
    assert rows(rendered.select("id", "rendered")) == rows(expected)


RULE = """criterion string, formula string, fix_text string, valid_from {time},
    valid_to {time}, columns string, error_code string, error_text string,
    granularity string, rule_number string"""


def rules(spark, entries, time="timestamp"):
    return spark.createDataFrame(
        [
            (f"c{i}", formula, "fix", start, end, "a", "e", "t", "g", str(i))
            for i, (formula, start, end) in enumerate(entries)
        ],
        RULE.format(time=time),
    )


@pytest.mark.parametrize("time", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("formulas_per_scan", [200, 1])
def test_quality_counts_failures_of_rules_in_force(spark, time, formulas_per_scan):
    data = spark.createDataFrame([(1, "x"), (5, None), (None, "y")], "a int, b string")
    first, last = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    entries = [
        ("a > 2", first, last),
        ("a > 2", None, None),
        ("b IS NOT NULL", last, None),
        ("a < 0", dt.datetime(2024, 6, 2), None),
        ("a < 0", first, dt.datetime(2024, 5, 31)),
        (None, first, last),
    ]
    found = ops.evaluate_quality(data, rules(spark, entries, time), last, formulas_per_scan)
    assert rows(found.select("rule_number", "rows_checked", "rows_failed")) == Counter(
        [("0", 3, 2), ("1", 3, 2), ("2", 3, 1), ("5", None, None)]
    )


def test_quality_of_no_rows_and_no_rules(spark):
    data = spark.createDataFrame([], "a int")
    one = rules(spark, [("a > 2", None, None)])
    found = ops.evaluate_quality(data, one, "2024-01-01")
    assert rows(found.select("rows_checked", "rows_failed")) == Counter([(0, 0)])
    none = ops.evaluate_quality(data, one.where("false"), "2024-01-01")
    assert none.columns == found.columns and none.count() == 0


def seen_rows(spark, values, kinds):
    """A table and a counter of the rows that Spark has read of it."""
    seen = spark.sparkContext.accumulator(0)

    def told(row):
        seen.add(1)
        return row

    rdd = spark.sparkContext.parallelize(values, 2).map(told)
    return spark.createDataFrame(rdd, kinds), seen


def test_bad_formulas_cost_no_further_scan(spark):
    data, seen = seen_rows(spark, [(i, i % 3, str(i)) for i in range(30)], "a int, z int, t string")
    bad = {
        "a / z > 1": "DIVIDE_BY_ZERO",
        "1 + a / z > 1": "DIVIDE_BY_ZERO",
        "CAST(concat('x', t) AS int) > 1": "CAST_INVALID_INPUT",
        "a * 1000000000 > 0": "ARITHMETIC_OVERFLOW",
        "element_at(array(1, 2), z + 1) > 0": "INVALID_ARRAY_INDEX_IN_ELEMENT_AT",
    }
    good = [f"a + {i} > 10 AND z + a / (z + 1) >= 0" for i in range(40)]
    listed = [*bad, *good, "a > z / (z + 1)", "z IS NULL"]
    found = ops.evaluate_quality(data, rules(spark, [(f, None, None) for f in listed]), "2024-01-01")
    got = {r["formula"]: (r["rows_checked"], r["rows_failed"], r["error"]) for r in found.collect()}
    assert {f: got[f] for f in bad} == {f: (None, None, error) for f, error in bad.items()}
    for i, formula in enumerate(good):
        assert got[formula] == (30, max(0, 11 - i), None)
    assert got["z IS NULL"] == (30, 30, None)
    assert seen.value == 30


def test_counters_are_added_batch_by_batch(spark, monkeypatch):
    data = spark.range(5).selectExpr("CAST(id AS int) AS a")
    batches = []
    real = quality._counts
    monkeypatch.setattr(quality, "_counts", lambda df, f: batches.append(len(f)) or real(df, f))
    listed = [f"a < {i}" for i in range(11)] + ["a / (a - 2) > 0", "no_such > 1"]
    found = ops.evaluate_quality(
        data, rules(spark, [(f, None, None) for f in listed]), "2024-01-01", 4
    )
    got = {r["formula"]: (r["rows_failed"], r["error"]) for r in found.collect()}
    assert max(batches) <= 4 and sum(batches) == 12
    assert {got[f"a < {i}"] for i in range(11)} == {(max(0, 5 - i), None) for i in range(11)}
    assert got["a / (a - 2) > 0"] == (None, "DIVIDE_BY_ZERO")
    assert got["no_such > 1"][1].startswith("UNRESOLVED_COLUMN")


def test_quality_counts_many_formulas_in_one_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    formulas = [f"l_quantity > {i}" for i in range(60)]
    plan = plan_of(quality._passed(lines, formulas))
    assert plan.count("Scan parquet") <= 2  # the list of nodes and its details
    assert "ReadSchema: struct<l_quantity:double>" in plan


def test_a_bad_formula_does_not_spoil_the_others(spark):
    data = spark.createDataFrame([(1, 0), (5, 2), (None, 1)], "a int, z int")
    formulas = ["a > 2", "a / z > 1", "nope > 1", "a +", "a", "max(a) > 1", "z >= 0", None]
    found = ops.evaluate_quality(data, rules(spark, [(f, None, None) for f in formulas]), "2024-01-01")
    counts = {r["formula"]: (r["rows_checked"], r["rows_failed"]) for r in found.collect()}
    assert counts["a > 2"] == (3, 2) and counts["z >= 0"] == (3, 0)
    errors = {r["formula"]: r["error"] for r in found.collect()}
    assert [f for f in formulas if errors[f] is None] == ["a > 2", "z >= 0", None]
    assert errors["a / z > 1"] == "DIVIDE_BY_ZERO" and "UNRESOLVED_COLUMN" in errors["nope > 1"]
    with settings(spark, spark__sql__ansi__enabled="false"):
        lenient = ops.evaluate_quality(data, rules(spark, [("a / z > 1", None, None)]), "2024-01-01")
        assert rows(lenient.select("rows_checked", "rows_failed", "error")) == Counter([(3, 2, None)])


def test_quality_criteria_types(spark):
    source = rules(spark, [("a > 2", dt.datetime(2024, 1, 1), None)]).selectExpr(
        "'it''s' as theme", "'t' as target_name", "*"
    )
    source = source.withColumn("error_code", F.lit(7)).withColumn(
        "valid_to", F.lit("2024-05-06 07:08:09")
    )
    found = ops.quality_criteria(source, "it's", "t")
    assert [f.dataType.simpleString() for f in found.schema] == (
        ["string"] * 3 + ["timestamp"] * 2 + ["string"] * 5
    )
    row = found.first()
    assert (row["error_code"], row["valid_to"]) == ("7", dt.datetime(2024, 5, 6, 7, 8, 9))


def window_table(spark):
    day = dt.datetime(2024, 1, 1)
    later = dt.datetime(2024, 1, 3, 12)
    return spark.createDataFrame(
        [(1, 10, day, later, "a"), (2, 10, day, None, "b"), (3, 20, day, later, "c")],
        """extraction_id int, target_id int, delta_start timestamp_ntz,
           delta_end timestamp_ntz, note string""",
    )


def test_deltas_move_by_extraction_or_target(spark):
    day, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3, 12)
    after = dt.datetime(2024, 1, 6)
    ids = spark.createDataFrame([(1,), (1,), (9,), (None,)], "extraction_id int")
    assert rows(ops.advance_deltas(window_table(spark), ids)) == Counter(
        [(1, 10, later, after, "a"), (2, 10, day, None, "b"), (3, 20, day, later, "c")]
    )
    ids = spark.createDataFrame([(10,)], "target_id int")
    assert rows(ops.advance_deltas(window_table(spark), ids, "target_id")) == Counter(
        [(1, 10, later, after, "a"), (2, 10, None, None, "b"), (3, 20, day, later, "c")]
    )
    with pytest.raises(ValueError, match="key"):
        ops.advance_deltas(window_table(spark), ids, "note")


def test_hot_target_is_split_when_deltas_move(spark):
    windows = spark.range(0, 60_000, 1, 8).selectExpr(
        "id as extraction_id",
        "if(id % 3 = 0, 7, id % 5000) as target_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 9) as delta_start",
        "timestamp_ntz'2024-02-01 00:00:00' as delta_end",
    )
    ids = spark.range(5_000).selectExpr("id as target_id")
    with settings(spark, **SMALL_LIMITS):
        plan = plan_of(ops.advance_deltas(windows, ids, "target_id"))
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        moved = ops.advance_deltas(windows, ids, "target_id", max_broadcast_bytes=0)
        assert "SortMergeJoin(skew=true)" in final_plan_of(moved)
        assert moved.where("delta_start = timestamp_ntz'2024-02-01 00:00:00'").count() == 60_000
