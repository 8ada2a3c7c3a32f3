"""The corpus pipeline: what a training corpus goes through, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All
but the last give back the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from guidepost.llm.decontaminate import drop_contaminated
from guidepost.llm.mixing import mix
from guidepost.llm.pii import redact
from guidepost.llm.queries import table
from guidepost.llm.simhash import drop_near_duplicates
from guidepost.llm.toxicity import drop_toxic
from guidepost.sources.scratch import drop_table, snapshot


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models call toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints stays: shingles of three words,
    at most two different bits."""
    return drop_near_duplicates(docs, length=3, reach=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that tiles cover half of a benchmark item in go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    return redact(docs, size="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that each source comes near its target."""
    return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

# Learned scores, tiling and deobfuscation are no SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a stored table that the next
    stage reads and that is dropped when that stage is stored."""
    docs, stored = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = snapshot(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if stored is not None:
            drop_table(stored)
        stored = docs
    return STAGES[-1][1](spark, docs, sf_dir)
