from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from itertools import islice

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column, free_name
from guidepost.operators.lookups import is_target
from guidepost.sources import new_scratch_path, write_table

# Fixed order of the result.
CRITERIA_COLUMNS = (
    "criterion",
    "formula",
    "fix_text",
    "valid_from",
    "valid_to",
    "columns",
    "error_code",
    "error_text",
    "granularity",
    "rule_number",
)
VALIDITY_COLUMNS = ("valid_from", "valid_to")


def quality_criteria(rules: DataFrame, theme: str, target: str) -> DataFrame:
    """Quality rules of a target in the ten-column form: eight texts and two timestamps."""

    def conform(name: str):
        if name not in VALIDITY_COLUMNS:
            return F.col(name).cast("string").alias(name)
        if isinstance(rules.schema[name].dataType, T.TimestampNTZType):
            return F.col(name)
        return F.col(name).cast("timestamp").alias(name)

    return rules.where(is_target(theme, target)).select(
        *[conform(name) for name in CRITERIA_COLUMNS]
    )


def valid_rules(rules: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Rules in force at a moment; both ends count, and a null end is open."""

    def moment(name: str):
        return F.lit(str(as_of)).cast(rules.schema[name].dataType)

    begun = F.col("valid_from").isNull() | (F.col("valid_from") <= moment("valid_from"))
    lasting = F.col("valid_to").isNull() | (F.col("valid_to") >= moment("valid_to"))
    return rules.where(begun & lasting)


def evaluate_quality(
    df: DataFrame, rules: DataFrame, as_of: dt.date | str, formulas_per_scan: int = 200
) -> DataFrame:
    """Every rule valid at ``as_of`` with the rows of ``df`` it checked and that failed it.

    A formula is a Spark SQL condition on the columns of ``df``; a row passes if it is true, so
    null fails. Users edit formulas, so one that cannot be used does not spoil the others: its
    ``error`` says why (it does not resolve, is no condition, holds an aggregate, or fails on a row, as
    a division by zero does under ANSI mode) and its counts are null. A null formula has
    neither counts nor error. How rules are applied is this library's own definition.

    The formulas are counted here and now, up to ``formulas_per_scan`` in one aggregate over
    ``df``: a scan whose shuffle holds a row of counters per task. A formula that fails on a row is caught
    there, so it costs no further scan; its error is found out on one such row that the scan
    brings along. Formulas are query text, so the distinct ones come to the driver, a batch at
    a time; the counts of a batch are added to a stored table, which the rules are joined with. Pass a
    stored table if ``df`` may change between batches.
    """
    spark = df.sparkSession
    valid = valid_rules(rules, as_of)
    formulas = valid.select("formula").where(F.col("formula").isNotNull()).distinct()
    counters = new_scratch_path(spark, "quality-counts")
    write_table(spark.createDataFrame([], COUNTERS), counters)
    for batch in _batches((row["formula"] for row in formulas.toLocalIterator()), formulas_per_scan):
        errors = {text: _analysis_error(df, text) for text in batch}
        counted = [(text, None, None, error) for text, error in errors.items() if error]
        counted += _counts(df, [text for text, error in errors.items() if not error])
        write_table(spark.createDataFrame(counted, COUNTERS).coalesce(1), counters, mode="append")
    found = spark.read.schema(COUNTERS).parquet(counters)
    return valid.join(found, "formula", "left").select(
        *valid.columns, "rows_checked", "rows_failed", "error"
    )


COUNTERS = "formula string, rows_checked bigint, rows_failed bigint, error string"


def _batches(items: Iterator[str], size: int) -> Iterator[list[str]]:
    while batch := list(islice(items, size)):
        yield batch


def _error_name(error: PySparkException) -> str:
    return error.getCondition() or type(error).__name__


def _analysis_error(df: DataFrame, formula: str) -> str | None:
    """Why a formula is no condition on the rows of ``df``, if it is none."""
    try:
        df.where(F.expr(formula)).schema  # noqa: B018  analysis happens on the way
    except PySparkException as error:
        return _error_name(error)
    return None


def _counts(df: DataFrame, formulas: list[str]) -> list[tuple]:
    """Counts of the formulas, all in one scan."""
    if not formulas:
        return []
    counted = _passed(df, formulas)
    row = counted.first()
    rows = row["rows_checked"]
    found = []
    for i, text in enumerate(formulas):
        if row[f"raised_{i}"]:
            example = row[f"example_{i}"]
            kind = counted.schema[f"example_{i}"].dataType
            found.append((text, None, None, _row_error(df, text, example, kind)))
        else:
            found.append((text, rows, rows - row[f"passed_{i}"], None))
    return found


def _named_in(df: DataFrame, formula: str) -> list[str]:
    """The columns that a formula may use: those whose names are in its text."""
    text = formula.lower()
    return [name for name in df.columns if name.lower().replace("`", "``") in text]


def _passed(df: DataFrame, formulas: list[str]) -> DataFrame:
    """One row: rows_checked and, for each formula, how many rows passed, on how many it failed with
    an error, and one of these.

    ``try_to_binary`` gives null where its argument cannot be evaluated, whatever the reason;
    the outcome is a text, so it is never null otherwise. A formula stands behind a condition that always holds,
    as Spark would compute what several formulas have in common beforehand, outside of that.
    """
    always = F.spark_partition_id() >= 0

    def outcome(text: str) -> Column:
        told = F.when(F.expr(text), F.lit("+")).otherwise(F.lit("-"))
        return F.try_to_binary(F.when(always, told), F.lit("utf-8"))

    outcomes = {free_name(df, f"outcome_{i}"): outcome(text) for i, text in enumerate(formulas)}
    tried = df.select(*[column(name) for name in df.columns], *[c.alias(n) for n, c in outcomes.items()])
    totals = [F.count(F.lit(1)).alias("rows_checked")]
    for i, (text, name) in enumerate(zip(formulas, outcomes)):
        found = column(name)
        used = F.struct(F.lit(1), *[column(c) for c in _named_in(df, text)])
        totals += [
            F.count(F.when(found == F.lit(b"+"), F.lit(1))).alias(f"passed_{i}"),
            F.count_if(found.isNull()).alias(f"raised_{i}"),
            F.first(F.when(found.isNull(), used), ignorenulls=True).alias(f"example_{i}"),
        ]
    return tried.agg(*totals)


def _row_error(df: DataFrame, formula: str, example: Row, kind: T.StructType) -> str:
    """The error that a formula ends with on a row."""
    try:
        row = df.sparkSession.createDataFrame([example], kind)
        row.select(F.expr(formula).cast("string")).collect()
    except PySparkException as error:
        return _error_name(error)
    return "FAILED_ON_A_ROW"
