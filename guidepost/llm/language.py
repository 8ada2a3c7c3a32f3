"""Language identification by error-correcting output codes.

Each language has a codeword. For each of its bits a binary classifier on hashed byte n-grams
says how sure it is of a one; the language whose codeword loses least is chosen, bits
weighing by how far their classifier can be trusted. A close second makes a text ambiguous.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column
from guidepost.llm.frames import Shared, id_and_bytes, in_held_out, per_row

TRAINING_ROWS = 4000  # bound of the sample to learn from, in equal parts for each language
FOLDS, HELD_OUT = 4, 2
FEATURES = 4096
FEATURE_BITS = 12
SIZES = (1, 2, 3)  # bytes of an n-gram
MOST_EXHAUSTIVE = 6  # languages for which the code has all bits that part them
UNKNOWN = "und"
CLOSE = 0.2  # the second best within this share of the best makes a text ambiguous
ROWS_AT_ONCE = 512

_PLAIN = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in bytes(range(256)).lower())
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(raw: bytes | None) -> bool:
    if not raw:
        return False
    if _ASCII_LETTER.search(raw):
        return True
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def profile(raw: bytes | None) -> np.ndarray:
    """Square roots of the shares of the hashed n-grams, of unit length; zeros without any."""
    counts = np.zeros(FEATURES)
    text = b" " + (raw or b"").translate(_PLAIN) + b" "
    buf = np.frombuffer(text, np.uint8)
    for a in range(0, len(buf), 1 << 22):
        part = buf[a : a + (1 << 22) + SIZES[-1] - 1].astype(np.uint32)
        for size in SIZES:
            count = max(0, min(1 << 22, len(part) - size + 1))
            code = np.full(count, size, np.uint32)
            for k in range(size):
                code = code * np.uint32(257) + part[k : k + count]
            code *= np.uint32(2654435761)
            counts += np.bincount(code >> np.uint32(32 - FEATURE_BITS), minlength=FEATURES)
    return np.sqrt(counts / max(counts.sum(), 1))


def profiles(texts: list[bytes | None]) -> np.ndarray:
    return np.array([profile(t) for t in texts], np.float32).reshape(len(texts), FEATURES)


def codewords(count: int) -> np.ndarray:
    """A row of -1 and 1 for each class. Few classes get every way to part them; more get random
    codes, of which the one with the farthest nearest pair is taken."""
    if count <= MOST_EXHAUSTIVE:
        bits = max(1, 2 ** (count - 1) - 1)
        table = (np.arange(1, bits + 1)[None, :] >> np.arange(count)[:, None]) & 1
        return (2 * table - 1).astype(float)
    bits = int(np.ceil(10 * np.log2(count)))
    best, farthest = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], (count, bits))
        nearest = int(((bits - code @ code.T) / 2 + bits * np.eye(count)).min())
        if nearest > farthest:
            best, farthest = code, nearest
    return best


@dataclass
class Model:
    names: list[str]
    code: np.ndarray = field(default_factory=lambda: np.ones((0, 0)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES + 1, 0)))
    trust: np.ndarray = field(default_factory=lambda: np.ones(0))

    def margins(self, found: np.ndarray) -> np.ndarray:
        return found @ self.weights[:-1] + self.weights[-1]

    def decoded(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each profile the best class, its probability, and whether another is close."""
        margin = self.margins(found)
        loss = np.stack(
            [np.logaddexp(0, -margin * word) @ self.trust for word in self.code], axis=1
        )
        best = loss.argmin(1)
        odds = np.exp(-(loss - loss.min(1, keepdims=True)))
        odds /= odds.sum(1, keepdims=True)
        ordered = np.sort(loss, axis=1)
        second = ordered[:, 1] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        close = second - ordered[:, 0] < CLOSE * np.maximum(second, 1e-9)
        return best, odds[np.arange(len(best)), best], close


def fit(found: np.ndarray, names: list[str], rounds: int = 300) -> Model:
    """Logistic regressions for all bits at once, by accelerated gradient descent. A bit's trust
    is its margin over guessing on a fifth of the rows, which the classifiers that give it did not see;
    the classifiers that are kept have seen all rows."""
    classes = sorted(set(names))
    if not classes:
        return Model([])
    code = codewords(len(classes))
    truth = code[np.searchsorted(classes, names)]
    inputs = np.hstack([found, np.ones((len(found), 1), np.float32)]).astype(np.float32)

    def descend(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        weights = np.zeros((x.shape[1], y.shape[1]), np.float32)
        ahead = weights
        step = np.float32(4.0 / (2 * max(len(x), 1)) * len(x))
        for k in range(rounds):
            p = 1 / (1 + np.exp(np.clip(y * (x @ ahead), -30, 30)))
            gradient = -(x.T @ (y * p).astype(np.float32)) / len(x) + 1e-5 * ahead
            new = ahead - step * gradient
            ahead = new + np.float32(k / (k + 3)) * (new - weights)
            weights = new
        return weights

    aside = np.arange(len(inputs)) % 5 == 0
    trust = np.ones(code.shape[1])
    if aside.any() and (~aside).any():
        trial = descend(inputs[~aside], truth[~aside])
        right = (np.sign(inputs[aside] @ trial) == truth[aside]).mean(0)
        trust = np.clip(2 * right - 1, 0.05, 1)
    return Model(classes, code, descend(inputs, truth).astype(float), trust)


def train_model(docs: DataFrame, doc_id: str, text: str, lang: str, rows: int) -> Model:
    """Learns from about ``rows`` different texts that have a language and are not held out, the same
    number of each language as far as it has them."""
    known = docs.select(
        column(doc_id).alias("own"), column(text).cast("binary").alias("text"),
        column(lang).alias("id"),
    )
    known = known.where(F.col("id").isNotNull() & ~in_held_out(F.col("own"), FOLDS, HELD_OUT))
    # Hashing the text makes copies stand or fall together; they are counted once.
    hashed = F.xxhash64("id", "text")
    texts = known.groupBy("id").agg(F.approx_count_distinct(hashed).alias("texts"))
    counts = {row["id"]: max(1, row["texts"]) for row in texts.collect()}
    if not counts:
        return Model([])
    each = rows / len(counts)
    share = F.create_map(
        *[F.lit(x) for name, n in sorted(counts.items()) for x in (name, min(1.0, each / n))]
    )
    chosen = known.where(F.pmod(hashed, F.lit(1 << 20)) < share[F.col("id")] * (1 << 20))
    kinds = T.StructType().add("id", "string").add("profile", "binary")

    def describe(ids: list, texts: list[bytes | None]) -> dict[str, list]:
        found = profiles(texts).astype(np.float16)
        return {"id": ids, "profile": [row.tobytes() for row in found]}

    sample = per_row(chosen.select("id", "text"), kinds, describe).distinct().collect()
    sample.sort(key=lambda row: (row["id"], row["profile"]))
    found = np.frombuffer(b"".join(row["profile"] for row in sample), np.float16)
    return fit(found.reshape(-1, FEATURES).astype(np.float32), [row["id"] for row in sample])


def identify(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = TRAINING_ROWS,
) -> DataFrame:
    """id, held_out, lang_pred, score and ambiguous of each row.

    ``lang_pred`` is one of the languages learned; ``und`` with score 0 if the text is null or
    has no letter, or if no row has a language. Null ids are not held out. Repeated rows are
    predicted alike; an empty table stays empty. Besides id, text and language no column is looked at.
    """
    model = train_model(docs, doc_id, text, lang, rows)
    held = Shared(docs.sparkSession, model)
    kinds = T.StructType([T.StructField("id", docs.schema[doc_id].dataType)])
    kinds = kinds.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def run(ids: list, texts: list[bytes | None]) -> dict[str, list]:
        own = held.value
        names, scores, close = [UNKNOWN] * len(ids), [0.0] * len(ids), [True] * len(ids)
        known = [i for i, t in enumerate(texts) if own.names and has_letter(t)]
        for a in range(0, len(known), ROWS_AT_ONCE):
            part = known[a : a + ROWS_AT_ONCE]
            best, score, near = own.decoded(profiles([texts[i] for i in part]))
            for i, b, s, n in zip(part, best.tolist(), score.tolist(), near.tolist()):
                names[i], scores[i], close[i] = own.names[b], s, n
        return {"id": ids, "lang_pred": names, "score": scores, "ambiguous": close}

    found = per_row(id_and_bytes(docs, doc_id, text), kinds, run)
    return found.select(
        F.col("id").alias(doc_id),
        in_held_out(F.col("id"), FOLDS, HELD_OUT).alias("held_out"),
        "lang_pred",
        "score",
        "ambiguous",
    )
