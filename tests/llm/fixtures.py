"""Small tables with the awkward rows that every operator has to take."""

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog and runs away. " * 3000

AWKWARD = [
    (1, "One plain sentence with some words in it.", "en", "a", 41),
    (1, "One plain sentence with some words in it.", "en", "a", 41),  # a repeated row
    (1, "Another text under the same id.", "en", None, 31),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, " \t\n ", "fr", "b", 4),
    (None, "A text without an id.", None, None, None),
    (None, None, None, None, None),
    (5, LONG, "en", "c", len(LONG)),
    (6, LONG, "en", "c", len(LONG)),  # a tie in everything but the id
    (7, "x" * 100_000, None, "c", 100_000),  # one very long word
    (8, "öäü ß 漢字 \U0001f600 …", "de", "d", 12),
]


def docs(spark: SparkSession, rows=AWKWARD, parts: int = 3) -> DataFrame:
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def with_clashing_names(df: DataFrame) -> DataFrame:
    """Extra columns under names that the operators use themselves."""
    names = [
        "id", "size", "point", "copies", "prefix", "held_out", "score", "predicted", "pattern",
        "kept", "base_failed", "batch", "blob", "found", "contamination", "row_key", "row_hash",
        "mixed_row", "label", "group", "text_", "spans", "SCORE_", "n_words",
    ]
    for name in names:
        df = df.withColumn(name, df["doc_id"] * 0 + 7)
    return df


def labels(spark: SparkSession, rows=()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark: SparkSession, rows=()) -> DataFrame:
    return spark.createDataFrame(list(rows), "item_id long, text string")
