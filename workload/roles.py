"""Test tables in the roles of control tables.

Each function renames or derives columns of one table, so every query grows with its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def days(count: int):
    return F.expr(f"INTERVAL {count} DAYS")


def days_from(start: str, count):
    """Midnight ``count`` days after a date, without time zone."""
    return F.date_add(F.lit(start).cast("date"), count).cast("timestamp_ntz")


def order_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a target: its priority the theme, its status the name."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("target_id"),
        F.col("o_orderpriority").alias("theme"),
        F.col("o_orderstatus").alias("target_name"),
        F.concat(F.lit("select * from t"), key.cast("string")).alias("select_template"),
        (key % 7).alias("delta_value_start"),
        (key % 11).alias("delta_value_end"),
        F.col("o_custkey").alias("period_id"),
        (key % 5).alias("period_interval"),
        (key % 30).alias("dest_column_id"),
        (key % 40).alias("version_column_id"),
        (key % 2).alias("mandatory_data"),
        (F.col("o_custkey") % 30).alias("duration_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("regulatory_flag"),
        F.col("o_custkey").alias("classification_id"),
    )


def line_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item is an extraction of its order, with a window of 30 days."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("extraction_id"),
        F.col("l_orderkey").alias("target_id"),
        F.col("l_shipdate").alias("delta_start"),
        (F.col("l_shipdate") + days(30)).alias("delta_end"),
    )


def customer_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer is a target: the market segment is the theme."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("target_id"),
        F.col("c_mktsegment").alias("theme"),
        F.col("c_name").alias("target_name"),
    )


def order_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is an extraction of its customer, with a window of 15 days."""
    key = F.col("o_orderkey")
    start = days_from("2024-01-01", (key % 25).cast("int"))
    return table(spark, sf_dir, "orders").select(
        key.alias("extraction_id"),
        F.col("o_custkey").alias("target_id"),
        F.col("o_custkey").alias("project"),
        F.when(key % 2 == 0, "click").otherwise("error").alias("theme"),
        (key % 3).alias("extraction_name"),
        start.alias("delta_start"),
        (start + days(15)).alias("delta_end"),
    )


def event_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is an entry of the partition index, at the hour of its time."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("project"),
        F.col("event_type").alias("theme"),
        (F.col("event_id") % 3).alias("extraction_name"),
        F.concat_ws(
            "/", "event_type", F.col("user_id").cast("string"), F.date_format(ts, "yyyy-MM-dd")
        ).alias("directory"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        (F.col("event_id") % 2).cast("int").alias("delta_flag"),
    )


def line_source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("target_id"),
        F.col("l_partkey").alias("dest_column_id"),
        F.concat("l_returnflag", "l_linestatus").alias("source_name"),
    )


def part_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("dest_column_id"),
        F.col("p_name").alias("dest_name"),
        F.col("p_type").alias("data_type"),
    )


def nation_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("dest_column_id"), F.col("n_name").alias("dest_name")
    )


def customer_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("period_id"), F.col("c_mktsegment").alias("period")
    )


def nation_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("duration_id"),
        F.concat(F.lit("P"), F.col("n_nationkey").cast("string"), F.lit("D")).alias(
            "iso_code"
        ),
    )


def customer_standard_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("dest_column_id"),
        F.col("c_mktsegment").alias("target_value"),
    )


def line_token_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("extraction_id"),
        (F.col("l_suppkey") % 30).alias("dest_column_id"),
        F.col("l_linenumber").alias("column_number"),
    )


def order_token_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("extraction_id"),
        F.col("o_orderpriority").alias("extraction_name"),
    )


def line_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("target_id"),
        F.dayofmonth(shipped).alias("day"),
        F.month(shipped).alias("month"),
        F.weekday(shipped).alias("weekday"),
        (F.weekday(shipped) < 5).alias("business_day_flag"),
    )


def customer_classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnRenamed(
        "c_custkey", "classification_id"
    )


def order_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a quality rule; most fields are numbers that become text."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("theme"),
        F.col("o_orderstatus").alias("target_name"),
        (key % 9).alias("criterion"),
        F.concat(F.lit("o_custkey <> "), F.col("o_custkey").cast("string")).alias("formula"),
        F.concat(F.lit("fix "), key.cast("string")).alias("fix_text"),
        F.col("o_orderdate").alias("valid_from"),
        (F.col("o_orderdate") + days(365)).alias("valid_to"),
        F.lit("o_custkey").alias("columns"),
        (key % 100).alias("error_code"),
        F.concat(F.lit("error "), (key % 100).cast("string")).alias("error_text"),
        (key % 4).alias("granularity"),
        key.alias("rule_number"),
    )


def nation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation is a rule for line items. Rule n is in force from day n of 2024 for ten
    days; formulas recur every eight rules. One names no column, one divides by zero."""
    key = F.col("n_nationkey")
    kind = key % 8
    start = days_from("2024-01-01", key)
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("criterion"),
        F.when(kind == 2, F.lit("no_such_column > 1"))
        .when(kind == 3, F.lit("l_quantity / (l_linenumber - 1) > 0"))
        .when(kind < 4, F.concat(F.lit("l_quantity BETWEEN 1 AND "), ((kind + 1) * 10).cast("string")))
        .when(kind < 6, F.concat(F.lit("l_discount <= 0.0"), kind.cast("string")))
        .when(kind == 6, F.lit("l_returnflag IS NOT NULL"))
        .otherwise(F.lit("nullif(l_linestatus, 'F') = 'O'"))
        .alias("formula"),
        F.lit("check the source").alias("fix_text"),
        start.alias("valid_from"),
        F.when(key % 5 != 0, start + days(10)).alias("valid_to"),
        F.lit("lineitem").alias("columns"),
        key.cast("string").alias("error_code"),
        F.col("n_name").alias("error_text"),
        F.lit("row").alias("granularity"),
        key.cast("string").alias("rule_number"),
    )


def order_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-token templates; tokens of nations over 24 or of a wrong region have no name."""
    key, region = F.col("o_orderkey"), F.col("o_custkey") % 5

    def token(number):
        return F.concat(
            F.lit("<<Columna_"),
            number.cast("string"),
            F.lit("_r"),
            region.cast("string"),
            F.lit(">>"),
        )

    return table(spark, sf_dir, "orders").select(
        key.alias("target_id"),
        F.concat(
            F.lit("select "), token(key % 30), F.lit(", "), token(region), F.lit(" from t")
        ).alias("select_template"),
    )


def nation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One token for each nation, named by its number and region."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("dest_name"),
        F.concat(
            F.lit("<<Columna_"),
            F.col("n_nationkey").cast("string"),
            F.lit("_r"),
            F.col("n_regionkey").cast("string"),
            F.lit(">>"),
        ).alias("token"),
    )


def nation_source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation is a source column of its region: a column of orders, or one they lack."""
    key = F.col("n_nationkey")
    names = ["O_ORDERKEY", "o_totalprice", "o_orderpriority", "o_orderstatus", "o_comment"]
    return table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("target_id"),
        key.alias("dest_column_id"),
        F.element_at(F.array(*map(F.lit, names)), F.floor(key / 5).cast("int") + 1).alias(
            "source_name"
        ),
    )


def nation_typed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation is a destination column; priority and status go to one of them."""
    group = F.floor(F.col("n_nationkey") / 5).cast("int")
    names = ["order_id", "price", "status", "status", "comment"]
    types = ["bigint", "decimal(18,2)", "text", "text", "text"]
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("dest_column_id"),
        F.element_at(F.array(*map(F.lit, names)), group + 1).alias("dest_name"),
        F.element_at(F.array(*map(F.lit, types)), group + 1).alias("data_type"),
    )


def region_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("target_id"),
        F.lit("usage").alias("theme"),
        F.col("r_name").alias("target_name"),
    )
