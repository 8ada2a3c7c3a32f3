from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column

DEFAULT_SCHEMA = "dbo"


@dataclass(frozen=True)
class Split:
    """How a JDBC table is read in parallel.

    Either an evenly filled numeric, date or timestamp column, cut into ``partitions`` ranges
    between ``lower`` and ``upper`` (rows outside are still read, by the outer ranges), or
    ``predicates``: one condition for each partition, for keys whose values bunch up. A row
    belongs to the first condition it meets; one more partition has the rows that meet
    none, so every row is read exactly once whatever the conditions are.
    """

    column: str | None = None
    lower: int | str | None = None
    upper: int | str | None = None
    partitions: int = 1
    predicates: Sequence[str] = ()

    def __post_init__(self) -> None:
        by_range = self.column is not None
        if by_range == bool(self.predicates):
            raise ValueError("a split needs either a column or predicates")
        if by_range and (self.lower is None or self.upper is None):
            raise ValueError(f"the split on {self.column!r} needs lower and upper")

    def conditions(self) -> list[str]:
        """``predicates`` made complete and free of overlap, as SQL."""
        cases = " ".join(f"WHEN {text} THEN {i}" for i, text in enumerate(self.predicates, 1))
        return [f"CASE {cases} ELSE 0 END = {i}" for i in range(len(self.predicates) + 1)]


@dataclass(frozen=True)
class QuantileSplit:
    """How a JDBC table is read in parallel, by ranges of ``column`` with equally many rows.

    The database itself finds the bounds, so keys may bunch up as they like; only a single value is
    never cut. Rows without a value are a range of their own. The column holds whole numbers, texts,
    dates or timestamps; texts have to be ordered in the database as their comparison says.
    """

    column: str
    partitions: int

    def bounds_query(self, table: str, name: str) -> str:
        """SQL that gives the least value of each of ``partitions`` equal parts."""
        tiles = f"SELECT {name} AS k, NTILE({self.partitions}) OVER (ORDER BY {name}) AS part"
        inner = f"{tiles} FROM {table} WHERE {name} IS NOT NULL"
        return f"(SELECT part, MIN(k) AS bound FROM ({inner}) tiles GROUP BY part) bounds"

    def conditions(self, name: str, bounds: Sequence[object]) -> list[str]:
        """One condition for each range; together they hold each row exactly once."""
        cuts = sorted({b for b in bounds if b is not None})[1:]
        texts = [_literal(cut) for cut in cuts]
        if not texts:
            return [f"{name} IS NOT NULL", f"{name} IS NULL"]
        middle = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(texts, texts[1:])]
        return [f"{name} < {texts[0]}", *middle, f"{name} >= {texts[-1]}", f"{name} IS NULL"]


def _literal(value: object) -> str:
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, (str, dt.date)):
        text = value if isinstance(value, str) else value.isoformat()
        return "'" + text.replace("'", "''") + "'"
    raise ValueError(f"a split column cannot hold {type(value).__name__} values")


@dataclass(frozen=True)
class ParquetSource:
    """Tables as parquet directories or files below ``root``."""

    root: str
    suffix: str = ".parquet"

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/{table}{self.suffix}")


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database.

    ``splits`` gives the parallel reading of large tables by table name; a table without one
    is a single partition. ``properties`` are Spark's JDBC options: user, password, driver,
    fetchsize and so on. Filters and column lists of later queries reach the database.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)
    splits: Mapping[str, Split | QuantileSplit] = field(default_factory=dict)
    quotes: str = "[]"

    def quoted(self, name: str) -> str:
        opening, closing = self.quotes
        return opening + name.replace(closing, closing * 2) + closing

    def qualified_name(self, table: str, schema: str) -> str:
        return f"{self.quoted(schema)}.{self.quoted(table)}"

    def read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        name = self.qualified_name(table, schema)
        properties = dict(self.properties)
        split = self.splits.get(table)
        if split is None:
            return spark.read.jdbc(self.url, name, properties=properties)
        if isinstance(split, QuantileSplit):
            key = self.quoted(split.column)
            query = split.bounds_query(name, key)
            # A row for each partition.
            found = spark.read.jdbc(self.url, query, properties=properties).collect()
            conditions = split.conditions(key, [row["bound"] for row in found])
            return spark.read.jdbc(self.url, name, predicates=conditions, properties=properties)
        if split.predicates:
            return spark.read.jdbc(
                self.url, name, predicates=split.conditions(), properties=properties
            )
        return spark.read.jdbc(
            self.url,
            name,
            column=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.partitions,
            properties=properties,
        )


def sql_server_source(
    connection: str, splits: Mapping[str, Split | QuantileSplit] | None = None
) -> JdbcSource:
    """A SQL Server database from ``Server=..;Database=..;User Id=..;Password=..;``."""
    pairs = [part.partition("=") for part in connection.split(";") if "=" in part]
    given = {key.strip().lower(): value for key, _, value in pairs}
    for key in ("server", "database", "user id"):
        given[key] = given.get(key, "").strip()
    missing = [k for k in ("server", "database", "user id", "password") if not given.get(k)]
    if missing:
        raise ValueError(f"the connection string lacks {', '.join(missing)}")
    # URL, port and driver class as the JDBC driver expects them.
    return JdbcSource(
        url=f"jdbc:sqlserver://{given['server']}:1433;databaseName={given['database']}",
        properties={
            "user": given["user id"],
            "password": given["password"],
            "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        },
        splits=splits or {},
    )


def read_table(
    spark: SparkSession,
    sources: Mapping[str, ParquetSource | JdbcSource],
    table: str,
    schema: str = DEFAULT_SCHEMA,
    source: str = "settings",
) -> DataFrame:
    """A whole table of the named source, read when it is used."""
    if source not in sources:
        raise ValueError(f"unknown source {source!r}; known are {sorted(sources)}")
    return sources[source].read(spark, table, schema)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """Write ``df`` as parquet without a ``_SUCCESS`` marker.

    With ``partition_by`` the rows of a directory are brought together first, so that tasks do
    not each leave a small file in every directory. The rebalance hint lets adaptive
    execution cut a directory that holds much of the data into several files. Read such a table
    with its schema: a reader without one guesses the types of directory values, so that
    ``01`` becomes 1. An empty text in such a column ends the write, as its directory would be read
    as null.
    """
    if partition_by:
        texts = [
            name for name in partition_by if isinstance(df.schema[name].dataType, T.StringType)
        ]
        refused = {
            name: F.when(
                column(name) == "", F.raise_error(F.lit(f"an empty {name} cannot be a directory"))
            ).otherwise(column(name))
            for name in texts
        }
        df = df.withColumns(refused).hint("rebalance", *partition_by)
    (
        df.write.mode(mode)
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .partitionBy(*partition_by)
        .parquet(path)
    )
