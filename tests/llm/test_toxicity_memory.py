"""What a worker holds while it scores texts."""

import random
import tracemalloc

import numpy as np

from guidepost.llm import toxicity
from guidepost.llm.toxicity import Model, _pair_places, drop_toxic, kneser_ney


class Sent:
    """Stands for a broadcast."""

    def __init__(self, value):
        self.value = value


def texts(count, size, seed):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(5000)]
    return [" ".join(rng.choices(words, k=size)).encode() for _ in range(count)]


def without_pairs(given):
    words = np.unique(toxicity._tokenized(given)[1])
    none = np.empty(0, np.float32)
    return Model(Sent({
        "words": words, "word_ratios": np.linspace(0.5, 2, len(words)).astype(np.float32),
        "begins": np.zeros(len(words) + 1, np.int64), "seconds": none, "pairs": none.astype(np.uint64),
        "pair_ratios": none,
    }))


def test_scoring_takes_some_texts_at_a_time():
    given = [*texts(4000, 300, 1), None, b""]
    model = without_pairs(given)
    tracemalloc.start()
    found = model.scores(given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * sum(len(t or b"") for t in given)
    # What is scored together changes nothing.
    alone = np.concatenate([model.scores([t]) for t in [*given[:50], *given[-2:]]])
    assert np.allclose(np.concatenate([found[:50], found[-2:]]), alone, rtol=1e-9)
    assert len(model.scores([])) == 0


def test_pairs_are_found_like_in_a_dictionary():
    rng = random.Random(2)
    pairs = sorted({(int(rng.paretovariate(1)) % 60, rng.randrange(60)) for _ in range(900)})
    begins = np.searchsorted([v for v, _ in pairs], np.arange(61))
    seconds = np.array([w for _, w in pairs], np.int32)
    wanted = [(v, w) for v in range(60) for w in range(60)]
    v, w = (np.array(x) for x in zip(*wanted))
    place, found = _pair_places(begins, seconds, v, w)
    slow = {pair: i for i, pair in enumerate(pairs)}
    assert found.tolist() == [pair in slow for pair in wanted]
    assert [int(p) for p, f in zip(place, found) if f] == [slow[x] for x in wanted if x in slow]


def test_a_pair_takes_eight_bytes(spark):
    train = spark.createDataFrame(
        [(i % 2, t) for i, t in enumerate(texts(300, 400, 3))], "label int, text binary"
    )
    model = kneser_ney(train, toxicity._word_counts(train, "text"))
    sent = model.ratios.value
    pairs = len(sent["pair_ratios"])
    assert pairs > 50_000
    assert sum(x.nbytes for x in sent.values()) < 8 * pairs + 24 * len(sent["words"])


def test_texts_that_are_no_utf8_are_scored(spark):
    rows = [(i, b"calm words here" if i % 2 else b"vile \xff\xfe words") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, raw binary")
    docs = docs.selectExpr("doc_id", "cast(raw AS string) AS text")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 = 0 AS int) AS toxic")
    scored = toxicity.toxicity(docs, labels).where("predicted = 0").select("doc_id").collect()
    kept = drop_toxic(docs, labels).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted(r[0] for r in scored)
