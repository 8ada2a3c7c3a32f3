"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary texts, with absolute discounts (0 < D < 1, from the
counts of counts), continuation counts for words, and backoff counts that both share: word counts
over all documents for words, the pairs of both classes for pairs. As in Kneser-Ney smoothing,
what the discount takes goes to the backoff so that the expected counts stay: an expression
that is expected e times gets D * (1 - exp(-e)) back. So a rare expression says little, but not
nothing, and one that both classes use alike says nothing. Copies are counted once, and a pair once
in a text.

A toxic text is ordinary in most places: each token comes from the toxic model with a small
probability, else from the ordinary one. The mean log-likelihood ratio of that mixture is turned
into a probability by a logistic curve; share and curve are fitted on labelled rows that no count
was taken from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column
from guidepost.llm.frames import (
    blocks,
    fresh,
    id_and_bytes,
    in_held_out,
    per_row,
    slices,
    word_count,
)
from guidepost.llm.samples import labelled
from guidepost.llm.textops import Words, mix64, sums_by_text, words_of
from guidepost.sources.scratch import snapshot

LABELLED_ROWS = 40_000  # bound of the sample of labelled rows
SCORED_BYTES = 512 * 1024  # of text that is scored at a time, beside a model of many times that size
SHARES = 0.1, 0.03, 0.01, 0.003  # of a toxic text's tokens that come from the toxic model
THRESHOLD = 0.3
EXPECTED = 0.1  # share of toxic texts before any label is seen, worth ten labels
FOLDS, HELD_OUT = 4, 2

_TOKENS = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def _tokenized(texts: list[bytes | None]) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of the texts, the key of each, and the key of its forerunner (0 before the first
    of a text)."""
    words = words_of([(t or b"").translate(_TOKENS) for t in texts])
    word = words.hash
    before = np.zeros(len(word), np.uint64)
    before[1:] = np.where(words.text[1:] == words.text[:-1], word[:-1], 0)
    return words, word, before


def _pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(mix64(before) + word * np.uint64(3))


def _word_counts(docs: DataFrame, text: str) -> DataFrame:
    """word and n: how often each word occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches):
            words, n = np.unique(_tokenized(texts)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"]
            )

    rows = docs.select(F.lit(0).alias("id"), column(text).cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _pair_counts(train: DataFrame) -> DataFrame:
    """v, w, n0 and n1: in how many texts of each label word v comes before word w."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            words, word, before = _tokenized(texts)
            pair = _pair_keys(before, word)
            once = np.unique(pair ^ mix64(words.text + 1), return_index=True)[1]
            label = np.array(rows, np.int64)[words.text[once]]
            _, first, at = np.unique(pair[once], return_index=True, return_inverse=True)
            n = [np.bincount(at[label == c], minlength=len(first)) for c in (0, 1)]
            keys = [x[once][first].view(np.int64) for x in (before, word)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (*keys, *n)], ["v", "w", "n0", "n1"]
            )

    rows = train.select(F.col("label").alias("id"), "text")
    counted = rows.mapInArrow(count, "v long, w long, n0 long, n1 long")
    return counted.groupBy("v", "w").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def discount(once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """The absolute discount for each class, from how many counts are one and two."""
    return (np.asarray(once) + 0.5) / (np.asarray(once) + 2.0 * np.asarray(twice) + 1)


def _arrays(rows: DataFrame, kinds: dict[str, type]) -> list[np.ndarray]:
    """Some columns of a table of bounded size, on the driver. They come partition by partition and as
    bytes, so that the driver holds them once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [batch.column(name).to_numpy().astype(kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in found], list(kinds)
            )

    packed = rows.select(*kinds).mapInArrow(pack, ", ".join(f"{name} binary" for name in kinds))
    parts: dict[str, list[np.ndarray]] = {name: [] for name in kinds}
    for row in packed.toLocalIterator():
        for name, kind in kinds.items():
            parts[name].append(np.frombuffer(row[name], kind))
    return [np.concatenate([np.empty(0, kind), *parts.pop(name)]) for name, kind in kinds.items()]


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key is in the ascending ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    order = np.argsort(wanted)  # neighbours are found faster
    at = np.empty(len(wanted), np.int64)
    at[order] = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
    return at, keys[at] == wanted


def _pair_places(
    begins: np.ndarray, seconds: np.ndarray, v: np.ndarray, w: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted pair of word numbers is, and whether it is there: those of ``v`` begin at
    ``begins[v]``, their second words ascend."""
    low, high = begins[v], begins[v + 1]
    wide = np.flatnonzero(low < high)
    while len(wide):
        middle = (low[wide] + high[wide]) // 2
        less = seconds[middle] < w[wide]
        low[wide[less]] = middle[less] + 1
        high[wide[~less]] = middle[~less]
        wide = wide[low[wide] < high[wide]]
    found = low < begins[v + 1]
    found[found] = seconds[low[found]] == w[found]
    return low, found


@dataclass
class Model:
    """Likelihood ratios, toxic to ordinary, of the words and pairs of the sample (``ratios``, sent
    once), and the curve. Other words have the ratio ``unseen``, other pairs that of their word.

    Every worker holds the ratios, so a pair takes eight bytes: the number of its second word, among
    those of its first word, and its ratio."""

    ratios: Broadcast
    unseen: float = 1.0
    share: float = SHARES[-1]
    slope: float = 1.0
    offset: float = 0.0
    prior: float = 0.5

    def evidence(
        self, texts: list[bytes | None], shares: Sequence[float]
    ) -> tuple[list[np.ndarray], np.ndarray]:
        """For each share the texts' mean log-likelihood ratios, and their tokens."""
        parts = [self._evidence(texts[part], shares) for part in slices(texts, SCORED_BYTES)]
        means = [np.concatenate([np.empty(0), *(own[i] for own, _ in parts)]) for i in range(len(shares))]
        return means, np.concatenate([np.empty(0, np.int64), *(counts for _, counts in parts)])

    def _evidence(
        self, texts: list[bytes | None], shares: Sequence[float]
    ) -> tuple[list[np.ndarray], np.ndarray]:
        sent = self.ratios.value
        words, word, before = _tokenized(texts)
        at, known = _places(sent["words"], word)
        ratio = np.full(len(word), self.unseen)
        ratio[known] = sent["word_ratios"][at[known]]
        ahead, both = _places(sent["words"], before)
        both = np.flatnonzero(both & known)
        place, seen = _pair_places(sent["begins"], sent["seconds"], ahead[both], at[both])
        ratio[both[seen]] = sent["pair_ratios"][place[seen]]
        counts = words.counts()
        sums = (sums_by_text(np.log1p(share * (ratio - 1)), words) for share in shares)
        return [x / np.maximum(counts, 1) for x in sums], counts

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """Probabilities; texts without a token get the share of toxic ones."""
        (mean,), counts = self.evidence(texts, [self.share])
        curve = 1 / (1 + np.exp(-np.clip(self.slope * mean + self.offset, -50, 50)))
        return np.where(counts > 0, curve, self.prior)


def kneser_ney(train: DataFrame, everywhere: DataFrame) -> Model:
    """The ratios of both models of ``train`` (label, text), backed off to the counts of
    ``everywhere`` (word, n).

    The driver and the tasks get the words and pairs of ``train`` only; ``everywhere`` stays a table.
    """
    context = train.sparkSession.sparkContext
    pairs = snapshot(_pair_counts(train), "toxicity-pairs")
    few = [F.count_if(F.col(f"n{c}") == k).alias(f"f{k}{c}") for k in (1, 2) for c in (0, 1)]
    seen = [F.count_if(F.col(f"n{c}") > 0).alias(f"n{c}") for c in (0, 1)]
    total = pairs.agg(*few, *seen).first()
    every = np.array([total["n0"], total["n1"]], float)
    if not every.all():  # a class without rows
        none = np.empty(0, np.uint64)
        empty = {"words": none, "word_ratios": none, "begins": np.zeros(1, np.int64),
                 "seconds": none, "pair_ratios": none}
        return Model(context.broadcast(empty))

    # How often a word goes before another one in a text of each class, and its forerunners.
    first = pairs.groupBy(F.col("v").alias("word")).agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    second = pairs.groupBy(F.col("w").alias("word")).agg(*seen).withColumnsRenamed({"n0": "c0", "n1": "c1"})
    known = first.join(second, "word", "full").join(everywhere, "word", "left")
    counts = {name: np.float32 for name in ("t0", "t1", "c0", "c1", "n")}
    words, *counted = _arrays(known.na.fill(0), {"word": np.int64, **counts})
    words = words.view(np.uint64)
    order = np.argsort(words)
    words, (t0, t1, c0, c1, n) = words[order], (x[order].astype(float) for x in counted)
    tokens = everywhere.agg(F.sum("n")).first()[0]
    backed = everywhere.agg(*[F.sum(1 - F.exp(-F.col("n") * x / tokens)) for x in every]).first()

    likely = []  # the continuation probability of each word, in both classes
    rest = []  # what a word outside the sample gets, over its share of all tokens
    for c, own in enumerate((c0, c1)):
        d = discount((own == 1).sum(), (own == 2).sum())
        back = d * (own > 0).sum() / backed[c]
        likely.append((np.maximum(own - d, 0) + back * -np.expm1(-every[c] * n / tokens)) / every[c])
        rest.append(back)
    p0, p1 = likely
    p0[(c0 + c1) == 0] = p1[(c0 + c1) == 0] = 1.0  # the start of a text is no word
    pooled = (every[0] * p0 + every[1] * p1) / every.sum()
    numbers = [x.astype(np.float32) for x in (t0, t1, p0 / pooled, p1 / pooled)]
    table = context.broadcast({"words": words, "numbers": numbers})
    own_discount = discount([total["f10"], total["f11"]], [total["f20"], total["f21"]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (t0, t1, tilt0, tilt1) = table.value["words"], table.value["numbers"]
        for batch in batches:
            v, w, *n = (batch.column(i).to_numpy() for i in range(4))
            v, w = v.view(np.uint64), w.view(np.uint64)
            before, at = _places(words, v)[0], _places(words, w)[0]
            totals = [t[before].astype(float) for t in (t0, t1)]
            share = (n[0] + n[1]) / (totals[0] + totals[1])
            # Both classes back off to the word after a forerunner that one of them does not have.
            both = (totals[0] > 0) & (totals[1] > 0)
            found = []
            for own, t, tilt, d in zip(n, totals, (tilt0, tilt1), own_discount):
                back = d * -np.expm1(-t * share * tilt[at])
                found.append(((np.maximum(own - d, 0) + back) / np.maximum(t, 1))[both])
            numbers = (pa.array(x[both].astype(np.int32)) for x in (before, at))
            ratio = pa.array((found[1] / found[0]).astype(np.float32))
            yield pa.RecordBatch.from_arrays([*numbers, ratio], ["v", "w", "ratio"])

    kinds = {"v": np.int32, "w": np.int32, "ratio": np.float32}
    v, w, ratios = _arrays(pairs.mapInArrow(weigh, "v int, w int, ratio float"), kinds)
    table.destroy()
    order = np.lexsort((w, v))
    begins = np.concatenate([[0], np.cumsum(np.bincount(v, minlength=len(words)))])
    del v
    w, ratios = w[order], ratios[order]
    del order
    sent = {"words": words, "word_ratios": (p1 / p0).astype(np.float32),
            "begins": begins, "seconds": w, "pair_ratios": ratios}
    return Model(context.broadcast(sent), unseen=float(rest[1] / rest[0]))


def without_copies(train: DataFrame) -> DataFrame:
    """label and text, one row for each label and sequence of tokens."""

    def digests(texts: pd.Series) -> pd.Series:
        tokens = ((t or b"").translate(_TOKENS).split() for t in texts)
        return pd.Series([blake2b(b" ".join(t), digest_size=16).digest() for t in tokens])

    digest = F.pandas_udf(digests, T.BinaryType())(F.col("text"))
    alike = train.select("label", "text", digest.alias("digest")).groupBy("label", "digest")
    return alike.agg(F.min("text").alias("text")).drop("digest")


def fit_curve(mean: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the greatest likelihood (Newton's method, with
    a weak pull to zero that keeps separable classes finite)."""
    scale = max(float(np.std(mean)), 1e-6)
    x = np.stack([mean / scale, np.ones(len(mean))])
    weights = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(weights @ x, -30, 30)))
        gradient = x @ (label - p) - 0.01 * weights
        curvature = (x * (p * (1 - p))) @ x.T + 0.01 * np.eye(2)
        weights = weights + np.clip(np.linalg.solve(curvature, gradient), -5, 5)
    return float(weights[0] / scale), float(weights[1])


def likelihood(mean: np.ndarray, label: np.ndarray, slope: float, offset: float) -> float:
    """The log-likelihood of the labels under a curve."""
    x = slope * mean + offset
    return float((label * x - np.logaddexp(0, x)).sum())


def train_model(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = LABELLED_ROWS,
) -> Model:
    """The model from about ``rows`` labelled rows outside the held-out fold.

    A quarter of them is kept from the counts and fits share and curve; all of the rest is
    counted. Without labelled rows of both classes every text gets the prior.
    """
    sample = snapshot(
        labelled(docs, labels, doc_id, text, label, FOLDS, HELD_OUT, rows), "toxicity-sample"
    )
    aside = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    everywhere = snapshot(_word_counts(docs, text), "toxicity-words")
    model = kneser_ney(without_copies(sample.where(~aside)), everywhere)

    def weigh(own: list, texts: list[bytes | None]) -> dict[str, list]:
        means, counts = model.evidence(texts, SHARES)
        return {"label": own, "means": np.stack(means, 1).tolist(), "n": counts.tolist()}

    kinds = T.StructType.fromDDL("label int, means array<double>, n long")
    rows_aside = sample.where(aside).select(F.col("label").alias("id"), "text")
    found = per_row(rows_aside, kinds, weigh).toPandas()
    seen = found["label"].to_numpy(float)
    model.prior = float((seen.sum() + 10 * EXPECTED) / (len(seen) + 10))
    used = found[found["n"] > 0]
    known = used["label"].to_numpy(float)
    if 0 < known.sum() < len(known):
        fitted = [(share, *fit_curve(x, known)) for share, x in zip(SHARES, np.stack(used["means"]).T)]
        fits = [likelihood(x, known, *curve) for (_, *curve), x in zip(fitted, np.stack(used["means"]).T)]
        model.share, model.slope, model.offset = fitted[int(np.argmax(fits))]
    else:
        model.slope, model.offset = 0.0, float(np.log(model.prior / (1 - model.prior)))
    return model


def toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """id, held_out, score and predicted (1 from 0.3 on) of each row.

    A null text, or one without letters and digits, gets the share of toxic rows as its score.
    A row with a null id is not held out. Repeated rows score alike; other columns are not
    looked at; an empty table stays empty.
    """
    model = train_model(docs, labels, doc_id, text, **options)
    kinds = T.StructType([T.StructField("id", docs.schema[doc_id].dataType)]).add("score", "double")

    def run(ids: list, texts: list[bytes | None]) -> dict[str, list]:
        return {"id": ids, "score": model.scores(texts).tolist()}

    scored = per_row(id_and_bytes(docs, doc_id, text), kinds, run)
    return scored.select(
        F.col("id").alias(doc_id),
        in_held_out(F.col("id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def _scorer(model: Model) -> Callable[[Column], Column]:
    def score(texts: pa.Array) -> pa.Array:
        rows = pa.RecordBatch.from_arrays([pa.nulls(len(texts)), texts], ["id", "text"])
        parts = [model.scores(own) for _, own in blocks([rows])]
        return pa.array(np.concatenate([np.empty(0), *parts]))

    return F.arrow_udf(score, T.DoubleType())


def drop_toxic(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, in their own columns.

    A null text or one without words says nothing, so it stays, however common toxic labels are;
    repeated rows stay or go together; an empty table stays empty.
    """
    model = train_model(docs, labels, doc_id, text, **options)
    score = _scorer(model)
    name = fresh(docs, "score")
    says_nothing = word_count(column(text)) == 0
    scored = docs.withColumn(name, score(column(text).cast("binary")))
    scored = scored.where((F.col(name) < THRESHOLD) | says_nothing)
    return scored.select(*[column(c) for c in docs.columns])
