"""Small DataFrame helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column

WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Words of a text; null has none. The separators are the six ASCII blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_and_bytes(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Two columns, ``id`` and ``text``; the text as UTF-8 bytes, null stays null."""
    return df.select(column(doc_id).alias("id"), column(text).cast("binary").alias("text"))


def in_held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text falls into ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def per_row(
    df: DataFrame, result: T.StructType, function: Callable[[list, list[bytes]], dict[str, list]]
) -> DataFrame:
    """``function`` over blocks of rows of ``id_and_bytes``; it gets ids and texts.

    Blocks end after ``BLOCK_BYTES`` of text, so memory does not follow the number of rows in an
    Arrow batch. A null text comes as None.
    """
    names = [f.name for f in result.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(result)
        for ids, texts in blocks(batches):
            found = function(ids, texts)
            arrays = [pa.array(found[n], type=schema.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, result)


class Shared:
    """A value of bounded size that tasks get once for each worker.

    It travels as bytes, so that classes of this package go with it.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self) -> dict:
        return {"_sent": self._sent}

    @property
    def value(self) -> object:
        if not hasattr(self, "_value"):
            self._value = cloudpickle.loads(self._sent.value)
        return self._value


class Kept(Shared):
    """A shared value that a worker keeps from task to task, with what it has learned meanwhile."""

    @property
    def value(self) -> object:
        if not hasattr(self._sent, "_kept"):
            self._sent._kept = cloudpickle.loads(self._sent.value)
        return self._sent._kept


BLOCK_BYTES = 2 * 1024 * 1024


def slices(texts: list[bytes | None], limit: int = BLOCK_BYTES) -> Iterator[slice]:
    """Slices of a list that hold some ``limit`` bytes each (or one longer text)."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"") + 64
        if size >= limit:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def blocks(
    batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES
) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts of whole rows, some ``limit`` bytes at a time (or one longer row)."""
    ids: list = []
    texts: list = []
    size = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            value = text.as_py()
            ids.append(key)
            texts.append(value)
            size += len(value or b"") + 64
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
