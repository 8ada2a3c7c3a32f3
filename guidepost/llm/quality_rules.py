"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation finds out
how far each can be trusted, and the posterior probability of quality decides."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.llm.frames import id_and_bytes, per_row
from guidepost.llm.textops import grams, mix64, repeated, sums_by_text, words_of
from guidepost.sources.scratch import snapshot

BAD, NONE, GOOD = 0, 1, 2

POOR_SHARE = 0.25  # of texts that are taken to be poor before any vote is heard

WINDOW = 8  # words of a window that may come twice

# Kinds of bytes that the rules count.
OTHER, SPACE, SYMBOL, INNER, UPPER, LOWER, DIGIT, SHOUT, STOP = range(9)
KIND = np.full(256, OTHER, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
KIND[list(b"#*$%&|<>")] = SYMBOL
KIND[0x80:0xC0] = INNER  # later bytes of a character
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[list(b"!?")] = SHOUT
KIND[list(b".")] = STOP

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_upper",
    "n_lower",
    "n_digits",
    "n_shouts",
    "n_stops",
)


def measure(ids: list, texts: list[bytes | None]) -> dict[str, list]:
    """What the rules look at, for each text."""
    words = words_of(texts)
    keys, at = grams(words.hash, words.text, WINDOW)
    twice = at[repeated(keys ^ mix64(words.text[at] + 1))]
    cover = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    own = words.hash ^ mix64(words.text + 1)
    order = np.argsort(own)
    new = np.ones(len(own), bool)
    new[order[1:]] = own[order[1:]] != own[order[:-1]]
    kinds, lines, again = [], [], []
    for text in texts:
        raw = text or b""
        kinds.append(np.bincount(KIND[np.frombuffer(raw, np.uint8)], minlength=9))
        filled = [line for line in raw.split(b"\n") if line.strip()]
        lines.append(len(filled))
        again.append(len(filled) - len(set(filled)))
    by_kind = np.array(kinds, np.int64).reshape(len(texts), 9)
    values = {
        "n_words": words.counts(),
        "word_chars": by_kind.sum(1) - by_kind[:, SPACE] - by_kind[:, INNER],
        "n_symbols": by_kind[:, SYMBOL],
        "n_dup_lines": again,
        "n_repeat_words": sums_by_text(covered, words),
        "n_lines": lines,
        "n_distinct_words": sums_by_text(new, words),
        "n_upper": by_kind[:, UPPER],
        "n_lower": by_kind[:, LOWER],
        "n_digits": by_kind[:, DIGIT],
        "n_shouts": by_kind[:, SHOUT],
        "n_stops": by_kind[:, STOP],
    }
    return {"id": ids} | {name: list(values[name]) for name in MEASURES}


@dataclass(frozen=True)
class Rule:
    """Votes on ``100 * part / whole``: bad beyond one limit, good beyond the other.

    With ``bad > good`` large shares are bad, else small ones. A rule abstains between its
    limits and on texts with fewer than ``least`` of ``whole``.
    """

    name: str
    part: str
    whole: str
    bad: float
    good: float
    least: int = 1

    def vote(self) -> Column:
        whole = F.expr(self.whole)
        share = 100 * F.expr(self.part) / whole
        high = self.bad > self.good
        return (
            F.when(whole < self.least, NONE)
            .when(share > self.bad if high else share < self.bad, BAD)
            .when(share <= self.good if high else share >= self.good, GOOD)
            .otherwise(NONE)
        )


RULES = (
    Rule("symbols", "n_symbols", "word_chars", bad=5, good=1, least=20),
    Rule("capitals", "n_upper", "n_upper + n_lower", bad=40, good=15, least=20),
    Rule("shouts", "n_shouts", "n_words", bad=20, good=5, least=5),
    Rule("sentences", "n_stops", "n_words", bad=0.5, good=2, least=50),
    Rule("long words", "word_chars", "n_words", bad=1400, good=1000, least=5),
    Rule("short words", "word_chars", "n_words", bad=200, good=300, least=5),
    Rule("digits", "n_digits", "word_chars", bad=30, good=10, least=20),
    Rule("repeated lines", "n_dup_lines", "n_lines", bad=60, good=5, least=5),
    Rule("repeated words", "n_repeat_words", "n_words", bad=30, good=5, least=20),
    Rule("vocabulary", "n_distinct_words", "n_words", bad=15, good=30, least=50),
)


def posteriors(
    votes: np.ndarray, counts: np.ndarray, poor: float = POOR_SHARE, rounds: int = 200
) -> tuple[np.ndarray, np.ndarray]:
    """Probability of quality for each pattern of votes, and each rule's accuracies.

    ``votes`` has a row for each pattern and a column for each rule, ``counts`` how many texts
    show the pattern. The latent class of a text is quality or not; a rule that votes says bad
    with a probability of its own in either class, and one that abstains says nothing. The
    start believes every bad vote; the rounds then find which rules deserve it. A rule's
    accuracy in a class is the share of right votes.

    The balance of the classes, ``poor``, is given. Faults of different kinds seldom meet in one
    text, so that votes alone would let the smaller class shrink to one kind of fault.
    """
    good = np.where((votes == BAD).any(1), 0.02, 0.98)
    bad, spoke = (votes == BAD).astype(float), (votes != NONE).astype(float)
    prior = np.log([poor, 1 - poor])[:, None]
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        says_bad = (weight @ bad + 1e-3) / (weight @ spoke + 1e-2)
        says_bad = np.clip(says_bad, 1e-9, 1 - 1e-9)
        log = prior + np.log(says_bad) @ bad.T + np.log(1 - says_bad) @ (spoke - bad).T
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
    return good, np.stack([says_bad[0], 1 - says_bad[1]])


FIRST_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    least_probability: float = 0.5,
) -> DataFrame:
    """Measures and verdict for each row: id, ``FIRST_MEASURES``, base_failed, kept, probability and
    the other counts of ``MEASURES``.

    All texts that pass the base rule vote (the others are decided, and would only teach what
    the base rule knows); patterns of votes are counted by Spark and the driver gets one row for
    each pattern that occurs, at most 3 to the number of rules. The probability is null where
    the base rule fails. A null text counts as empty: it has no words and fails it.
    Repeated rows are judged alike; other columns are not looked at; an empty table gives an empty result.
    """
    fields = [T.StructField("id", docs.schema[doc_id].dataType)]
    fields += [T.StructField(name, T.LongType()) for name in MEASURES]
    pattern = F.concat(*[rule.vote().cast("string") for rule in rules])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = snapshot(
        per_row(id_and_bytes(docs, doc_id, text), T.StructType(fields), measure)
        .withColumn("base_failed", failed)
        .withColumn("pattern", F.when(~F.col("base_failed"), pattern)),
        "quality-measures",
    )
    voters = measured.where(~F.col("base_failed"))
    patterns = voters.groupBy("pattern").count().orderBy("pattern").collect()
    votes = np.array([[int(v) for v in row["pattern"]] for row in patterns], int)
    counts = np.array([row["count"] for row in patterns], float)
    found = posteriors(votes.reshape(-1, len(rules)), counts)[0] if patterns else []
    verdicts = measured.sparkSession.createDataFrame(
        [(row["pattern"], float(p)) for row, p in zip(patterns, found)],
        "pattern string, probability double",
    )
    kept = F.coalesce(F.col("probability") >= least_probability, F.lit(False))
    return measured.join(F.broadcast(verdicts), "pattern", "left").select(
        F.col("id").alias(doc_id),
        *FIRST_MEASURES,
        "base_failed",
        kept.alias("kept"),
        "probability",
        *[name for name in MEASURES if name not in FIRST_MEASURES],
    )
