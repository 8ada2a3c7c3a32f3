"""Quality by supervised subword embeddings.

Hashed words, pairs of words and byte n-grams have vectors that are learned with the classifier: a text
is the mean of its vectors, and a softmax on it gives the probability of quality. Numpy trains
it by stochastic gradient descent in one task, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.llm.frames import Shared, id_and_bytes, in_held_out, per_row
from guidepost.llm.samples import labelled
from guidepost.llm.textops import grams, words_of
from guidepost.sources.scratch import snapshot

LABELLED_ROWS = 4000  # bound of the sample of labelled rows
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BITS = 15  # of a word's or an n-gram's number; n-grams follow the words
SIZES = (3, 4)  # bytes of an n-gram
SAME = np.uint64(0x5A5E << 48)  # stands for a word that follows itself
DIMENSIONS = 16
EPOCHS = 12
RATE = 2.0
AT_ONCE = 1 << 22


def _gram_numbers(text: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of the byte n-grams of a text, some at a time."""
    for a in range(0, len(text), AT_ONCE):
        part = text[a : a + AT_ONCE + SIZES[-1] - 1].astype(np.uint32)
        for size in SIZES:
            count = max(0, min(AT_ONCE, len(part) - size + 1))
            code = np.full(count, size, np.uint32)
            for k in range(size):
                code = code * np.uint32(257) + part[k : k + count]
            code *= np.uint32(2654435761)
            yield (code >> np.uint32(32 - BITS)).astype(np.int64) + (1 << BITS)


def _word_numbers(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the numbers of its words and of its pairs of words; all pairs of equal words
    have one number."""
    if not texts:
        return []
    words = words_of(texts)
    pairs, at = grams(words.hash, words.text, 2)
    pairs[words.hash[at] == words.hash[at + 1]] = SAME
    number = np.concatenate([words.hash, pairs]) >> np.uint64(64 - BITS)
    text = np.concatenate([words.text, words.text[at]])
    order = np.argsort(text, kind="stable")
    ends = np.cumsum(np.bincount(text, minlength=len(texts)))[:-1]
    return np.split(number[order].astype(np.int64), ends)


def bags(texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the distinct numbers of its words, pairs and n-grams, and how often each occurs."""
    found = []
    for text, words in zip(texts, _word_numbers(texts)):
        counts = np.bincount(words, minlength=2 << BITS)
        for numbers in _gram_numbers(np.frombuffer(text or b"", np.uint8)):
            counts += np.bincount(numbers, minlength=2 << BITS)
        used = np.flatnonzero(counts)
        found.append((used.astype(np.int32), counts[used].astype(np.int32)))
    return found


@dataclass
class Model:
    """As the text's vector is a mean and the softmax looks at a difference, what a number adds to
    the log-odds is one value: the product of its vector and the difference of the outputs."""

    odds: np.ndarray
    offset: float
    prior: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        found = np.full(len(texts), self.prior)
        for i, (text, words) in enumerate(zip(texts, _word_numbers(texts))):
            total, count = float(self.odds[words].sum()), len(words)
            for numbers in _gram_numbers(np.frombuffer(text or b"", np.uint8)):
                total += float(self.odds[numbers].sum())
                count += len(numbers)
            if count:
                logit = np.clip(total / count + self.offset, -50, 50)
                found[i] = 1 / (1 + np.exp(-logit))
        return found


def descend(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """Learns from (label, numbers, counts); the rate falls to zero along a line."""
    label = np.array([row[0] for row in rows], float)
    prior = float((label.sum() + 1) / (len(label) + 2))
    random = np.random.default_rng(7)
    size = (2 << BITS, DIMENSIONS)
    vectors = random.uniform(-1, 1, size).astype(np.float32) / DIMENSIONS
    outputs = np.zeros((2, DIMENSIONS), np.float32)
    offsets = np.log(np.array([1 - prior, prior], np.float32))
    shares = [(counts / counts.sum()).astype(np.float32) for _, _, counts in rows]
    steps = EPOCHS * len(rows)
    for epoch in range(EPOCHS):
        for turn, i in enumerate(random.permutation(len(rows))):
            numbers, share = rows[i][1], shares[i]
            if not len(numbers):
                continue
            rate = np.float32(RATE * (1 - (epoch * len(rows) + turn) / steps))
            mean = share @ vectors[numbers]
            logits = outputs @ mean + offsets
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[rows[i][0]] -= 1
            change = p @ outputs
            outputs -= rate * np.outer(p, mean)
            offsets -= rate * np.float32(0.1) * p
            vectors[numbers] -= rate * np.float32(10) * share[:, None] * change[None, :]
    odds = vectors @ (outputs[1] - outputs[0])
    return Model(odds.astype(np.float32), float(offsets[1] - offsets[0]), prior)


def train_model(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, rows: int
) -> Model:
    """Trains in one task on about ``rows`` labelled rows outside the held-out fold; a row brings
    at most ``2 << BITS`` numbers, however long its text. The driver gets the odds only."""
    sample = labelled(docs, labels, doc_id, text, label, FOLDS, HELD_OUT, rows)
    kinds = T.StructType.fromDDL("label int, numbers binary, counts binary")

    def describe(own: list, texts: list[bytes | None]) -> dict[str, list]:
        found = bags(texts)
        return {
            "label": own,
            "numbers": [n.tobytes() for n, _ in found],
            "counts": [c.tobytes() for _, c in found],
        }

    described = per_row(sample.select(F.col("label").alias("id"), "text"), kinds, describe)
    stored = snapshot(described.distinct(), "quality-sample")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_: list[tuple[int, bytes, bytes]] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            rows_ += zip(*columns)
        rows_.sort()
        model = descend(
            [(y, np.frombuffer(n, np.int32), np.frombuffer(c, np.int32)) for y, n, c in rows_]
        )
        values = [model.odds.tobytes(), model.offset, model.prior]
        names = ["odds", "offset", "prior"]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names)

    trained = stored.coalesce(1).mapInArrow(learn, "odds binary, offset double, prior double")
    row = trained.first()
    if row is None:
        return Model(np.zeros(2 << BITS, np.float32), 0.0, 0.5)
    return Model(np.frombuffer(row["odds"], np.float32), row["offset"], row["prior"])


def quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = LABELLED_ROWS,
) -> DataFrame:
    """id, held_out, score and predicted (1 from 0.3 on) of each row.

    A null or empty text gets the share of good rows as its score, and so do all texts if nothing
    is labelled (then one half). Rows with a null id are not held out. Repeated rows score
    alike and are learned from once; other columns are not looked at; an empty table stays empty.
    """
    model = train_model(docs, labels, doc_id, text, label, rows)
    held = Shared(docs.sparkSession, model)
    kinds = T.StructType([T.StructField("id", docs.schema[doc_id].dataType)]).add("score", "double")

    def run(ids: list, texts: list[bytes | None]) -> dict[str, list]:
        return {"id": ids, "score": held.value.scores(texts).tolist()}

    scored = per_row(id_and_bytes(docs, doc_id, text), kinds, run)
    return scored.select(
        F.col("id").alias(doc_id),
        in_held_out(F.col("id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
