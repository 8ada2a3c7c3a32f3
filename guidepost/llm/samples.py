"""Bounded samples of rows to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guidepost.functions import column
from guidepost.llm.frames import in_held_out
from guidepost.sources.scratch import snapshot

PARTS = 1 << 20


def about(df: DataFrame, rows: int, *by: Column) -> DataFrame:
    """All of ``df`` or, if it is longer, about ``rows`` of its rows, chosen by a hash of ``by``."""
    count = df.count()
    if count <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(*by), F.lit(PARTS)) < int(PARTS * rows / count))


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str,
    text: str,
    label: str,
    folds: int,
    held_out: int,
    rows: int,
) -> DataFrame:
    """id, text (as bytes) and label (0 or 1) of the documents to learn from.

    At most about ``rows`` labels outside the held-out fold are used, so their table is
    small and the documents need no shuffle. Null ids and labels teach nothing; an id with several
    labels has the largest.
    """
    known = labels.select(column(doc_id).alias("id"), column(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull())
    known = known.where(~in_held_out(F.col("id"), folds, held_out))
    chosen = about(known, rows, F.col("id")).groupBy("id").agg(F.max("label").alias("label"))
    chosen = snapshot(chosen, "labels")
    texts = docs.select(column(doc_id).alias("id"), column(text).cast("binary").alias("text"))
    return texts.join(F.broadcast(chosen), "id")
