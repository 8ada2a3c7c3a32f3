"""The registered queries. Each takes (spark, sf_dir) and covers one operator."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guidepost import operators as ops
from guidepost.sources import (
    ControlTable,
    ParquetSource,
    load_catalog,
    new_scratch_path,
    read_version,
    store_catalog,
    write_table,
)
from workload import roles

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

THEME, TARGET = "1-URGENT", "F"


def resolve_paths_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.resolve_paths(
        roles.customer_targets(spark, sf_dir),
        roles.order_extractions(spark, sf_dir),
        roles.event_index(spark, sf_dir),
        theme="BUILDING",
        mode="window",
    )


def resolve_paths_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.resolve_paths(
        roles.customer_targets(spark, sf_dir),
        roles.order_extractions(spark, sf_dir),
        roles.event_index(spark, sf_dir),
        theme="BUILDING",
        mode="flag",
    )


def extractions_for_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.extractions_for_target(
        roles.line_extractions(spark, sf_dir), roles.order_targets(spark, sf_dir), TARGET
    )


def comparison_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.comparison_info(
        roles.order_targets(spark, sf_dir),
        roles.customer_periods(spark, sf_dir),
        roles.nation_columns(spark, sf_dir),
        THEME,
        TARGET,
    )


def target_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.target_duration(
        roles.order_targets(spark, sf_dir), roles.nation_durations(spark, sf_dir), THEME, TARGET
    )


def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.column_mapping(
        roles.line_source_columns(spark, sf_dir),
        roles.order_targets(spark, sf_dir),
        roles.part_columns(spark, sf_dir),
        THEME,
        TARGET,
    )


def destination_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.destination_columns_of(
        roles.line_source_columns(spark, sf_dir),
        roles.order_targets(spark, sf_dir),
        roles.part_columns(spark, sf_dir),
        THEME,
        TARGET,
    )


def value_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.value_targets(
        roles.customer_standard_values(spark, sf_dir), roles.nation_columns(spark, sf_dir)
    )


def token_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.token_map(
        roles.line_token_sources(spark, sf_dir),
        roles.nation_columns(spark, sf_dir),
        roles.order_token_extractions(spark, sf_dir),
        THEME,
    )


def regulatory_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.regulatory_calendar(
        roles.order_targets(spark, sf_dir),
        roles.line_publications(spark, sf_dir),
        roles.customer_classifications(spark, sf_dir),
    )


def quality_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.quality_criteria(roles.order_rules(spark, sf_dir), THEME, TARGET)


def evaluate_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.evaluate_quality(
        roles.table(spark, sf_dir, "lineitem"),
        roles.nation_rules(spark, sf_dir),
        as_of="2024-01-15",
    ).select("rule_number", "criterion", "formula", "rows_checked", "rows_failed", "error")


def _order_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            ("o_orderkey", "order_id", "bigint"),
            ("o_totalprice", "price", "decimal(18,2)"),
            ("o_orderpriority", "priority", "int"),
            ("o_orderstatus", "status", "string"),
        ],
        "source_name string, dest_name string, data_type string",
    )


def apply_column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.apply_column_mapping(
        roles.table(spark, sf_dir, "orders"), _order_mapping(spark)
    )


def apply_resolved_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target's mapping, resolved and applied: one source is spelled in capitals, one is absent,
    and two share a destination."""
    mapping = ops.column_mapping(
        roles.nation_source_columns(spark, sf_dir),
        roles.region_targets(spark, sf_dir),
        roles.nation_typed_columns(spark, sf_dir),
        "usage",
        "ASIA",
    )
    orders = roles.table(spark, sf_dir, "orders")
    return ops.apply_column_mapping(orders, mapping, {"text": "string"}, absent="skip")


def count_bad_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_bad_casts(roles.table(spark, sf_dir, "orders"), _order_mapping(spark))


def standardize_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities and segments in a second spelling; one priority has no canonical value."""
    orders = roles.table(spark, sf_dir, "orders")
    customers = roles.table(spark, sf_dir, "customer")
    data = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey",
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("priority"),
        F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("segment"),
    )
    priorities = orders.where(F.col("o_orderpriority") != "5-LOW").select(
        F.lit("priority").alias("dest_name"), F.col("o_orderpriority").alias("target_value")
    )
    segments = customers.select(
        F.lit("segment").alias("dest_name"), F.col("c_mktsegment").alias("target_value")
    )
    return ops.standardize_values(data, priorities.union(segments))


def render_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.render_templates(
        roles.order_templates(spark, sf_dir), roles.nation_tokens(spark, sf_dir)
    ).select(
        "target_id", "rendered", F.array_join("unresolved", ",").alias("unresolved_tokens")
    )


def advance_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = roles.order_targets(spark, sf_dir).where(F.col("target_name") == TARGET)
    return ops.advance_deltas(
        roles.line_extractions(spark, sf_dir), moved.select("target_id"), key="target_id"
    )


def advance_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of a published table, moved by a run that is first cut short, then repeated twice."""
    root = new_scratch_path(spark, "published")
    ops.publish_windows(spark, root, roles.line_extractions(spark, sf_dir))
    ids = roles.order_targets(spark, sf_dir).where(F.col("target_name") == TARGET)
    some = ids.where(F.col("target_id") % 2 == 0)
    for part in (some, ids, ids):
        ops.advance_published(spark, root, "a run", part.select("target_id"), "target_id")
    return read_version(spark, root)


def advance_deltas_by_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    extractions = roles.line_extractions(spark, sf_dir)
    read = roles.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    ids = read.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("extraction_id"))
    return ops.advance_deltas(extractions, ids)


def advance_target_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delta values that targets have of their own."""
    targets = roles.order_targets(spark, sf_dir).select(
        "target_id", "theme", "delta_value_start", "delta_value_end"
    )
    moved = targets.where(F.col("theme") == THEME).select("target_id")
    return ops.advance_deltas(
        targets, moved, "target_id", start="delta_value_start", end="delta_value_end"
    )


def catalog_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table: one shuffle of a partial count for each table and task."""
    catalog = load_catalog(
        spark,
        {"settings": ParquetSource(sf_dir)},
        {name: ControlTable(name) for name in TABLES},
        names={},
    )
    return _row_counts(spark, catalog)


def _row_counts(spark: SparkSession, catalog: dict[str, DataFrame]) -> DataFrame:
    # An empty table still has its row of zero.
    none = spark.createDataFrame(
        [(name, 0) for name in TABLES], "table_name string, row_count bigint"
    )
    rows = [
        df.select(F.lit(name).alias("table_name"), F.lit(1).cast("bigint").alias("row_count"))
        for name, df in catalog.items()
    ]
    return (
        reduce(DataFrame.union, rows, none)
        .groupBy("table_name")
        .agg(F.sum("row_count").alias("row_count"))
    )


def stored_catalog_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts of one stored state of all tables."""
    entries = {name: ControlTable(name) for name in TABLES}
    catalog = load_catalog(spark, {"settings": ParquetSource(sf_dir)}, entries, names={})
    return _row_counts(spark, store_catalog(catalog, new_scratch_path(spark, "catalog")))


def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a table of directories with names such as 01, and read again."""
    part = F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0")
    orders = roles.table(spark, sf_dir, "orders").withColumn("part", part)
    path = new_scratch_path(spark, "orders")
    write_table(orders, path, partition_by=["part"])
    return spark.read.schema(orders.schema).parquet(path)


def _event_lake(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Events written as a lake, and its directories resolved through its index.

    The nations are extractions: each reads one event type over three days. The directories of one
    type, which is not the first by name, have a column that the others lack.
    """
    lake = new_scratch_path(spark, "lake")
    events = roles.table(spark, sf_dir, "events")
    daily = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    paid = F.col("event_type") == "purchase"
    amounts = daily.where(paid).withColumn("amount", F.col("event_id") * 10)
    write_table(daily.where(~paid), lake, partition_by=["event_type", "day"])
    write_table(amounts, lake, partition_by=["event_type", "day"], mode="append")

    index = (
        daily.select("event_type", "day")
        .distinct()
        .select(
            F.lit("lake").alias("project"),
            F.lit("events").alias("theme"),
            F.col("event_type").alias("extraction_name"),
            F.concat(
                F.lit("event_type="), "event_type", F.lit("/day="), "day"
            ).alias("directory"),
            F.substring("day", 1, 4).alias("year"),
            F.substring("day", 6, 2).alias("month"),
            F.substring("day", 9, 2).alias("day"),
            F.lit(0).alias("hour"),
        )
    )
    key = F.col("n_nationkey")
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    start = roles.days_from("2024-01-01", key)
    nations = roles.table(spark, sf_dir, "nation")
    extractions = nations.select(
        key.alias("extraction_id"),
        F.col("n_regionkey").alias("target_id"),
        F.lit("lake").alias("project"),
        F.lit("events").alias("theme"),
        F.element_at(kinds, key % 5 + 1).alias("extraction_name"),
        start.alias("delta_start"),
        (start + roles.days(2)).alias("delta_end"),
    )
    targets = roles.region_targets(spark, sf_dir)
    paths = ops.resolve_paths(targets, extractions, index, theme="usage", mode="window")
    return lake, paths


def _as_read(found: DataFrame) -> DataFrame:
    return found.select(
        "extraction_id",
        "event_id",
        "user_id",
        "event_type",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        "amount",
    )


def read_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directories of the event lake read back by name, each row with its extraction."""
    lake, paths = _event_lake(spark, sf_dir)
    return _as_read(ops.read_resolved(spark, paths, root=lake, options={"basePath": lake}))


def read_resolved_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event lake read at its root, its partitions joined with the resolved keys."""
    lake, paths = _event_lake(spark, sf_dir)
    keys = ["event_type", "day"]
    return _as_read(ops.read_resolved(spark, paths, root=lake, partition_columns=keys))

QUERIES = {
    query.__name__: query
    for query in (
        resolve_paths_window,
        resolve_paths_flag,
        extractions_for_target,
        comparison_info,
        target_duration,
        column_mapping,
        destination_columns,
        value_targets,
        token_map,
        regulatory_calendar,
        quality_criteria,
        evaluate_quality,
        apply_column_mapping,
        apply_resolved_mapping,
        count_bad_casts,
        standardize_values,
        render_templates,
        advance_deltas,
        advance_published,
        advance_deltas_by_extraction,
        advance_target_deltas,
        catalog_row_counts,
        stored_catalog_row_counts,
        table_round_trip,
        read_resolved,
        read_resolved_by_key,
    )
}
