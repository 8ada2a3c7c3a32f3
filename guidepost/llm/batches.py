"""Texts packed into batches, so that one row carries some megabytes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from guidepost.llm.frames import blocks, id_and_bytes

BATCH_BYTES = 4 * 1024 * 1024

Arrays = dict[str, list]


def packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int32).astype(np.int64)


def as_ints(values: np.ndarray) -> bytes:
    return np.asarray(values, np.int32).tobytes()


def map_rows(df: DataFrame, kinds: T.StructType, function: Callable[[dict], Arrays]) -> DataFrame:
    """``function`` takes a row as a dict and gives lists of the columns of ``kinds``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kinds)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                found = function(row)
                arrays = [pa.array(found[f.name], type=f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(run, kinds)


def text_batches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """batch, ids, sizes (bytes of each text, as 32-bit numbers), n_bytes and blob (the texts,
    compressed). A batch ends after ``BATCH_BYTES``; a null text counts as empty."""
    ids = T.ArrayType(docs.schema[doc_id].dataType)
    kinds = T.StructType.fromDDL("batch long").add("ids", ids)
    kinds = kinds.add("sizes", "binary").add("n_bytes", "long").add("blob", "binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kinds)
        task = TaskContext.get().partitionId() << 32
        for number, (own, texts) in enumerate(blocks(batches, BATCH_BYTES)):
            raw = [t or b"" for t in texts]
            sizes = np.array([len(t) for t in raw], np.int32)
            values = [task + number, own, sizes.tobytes(), int(sizes.sum(dtype=np.int64)),
                      packed(b"".join(raw))]
            arrays = [pa.array([v], type=f.type) for v, f in zip(values, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return id_and_bytes(docs, doc_id, text).mapInArrow(pack, kinds)


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of true flags begin and end (exclusive)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
    return edges[0::2], edges[1::2]
