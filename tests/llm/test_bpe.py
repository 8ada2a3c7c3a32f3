"""BPE against the public library, and against merging the lowest pair by hand."""

import base64
import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from guidepost.llm import bpe
from guidepost.llm.bpe import RankQueue, decode, encode, load_vocabulary, token_digests
from tests.llm.fixtures import AWKWARD, docs, with_clashing_names

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks,
        special_tokens={},
    )


def ids_of(vocabulary, text):
    return [i for _, block in vocabulary.encoded([text]) for i in block]


def by_hand(ranks, piece):
    """Merge the leftmost of the lowest pairs until there is none."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


# Letters, digits and others of old and new Unicode versions, blanks of all kinds, contractions.
SIGNS = [
    "a", "b", "e", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "'s", "'ll", "'", "1",
    "٣", "é", "ß", "漢", "\U0001f600", "՘", "࢏", "\U00011de0", "\U00033479", "-", "!?",
]


def test_equals_the_library_on_mixed_signs(vocabulary, library):
    rng = random.Random(5)
    texts = ["".join(rng.choices(SIGNS, k=rng.randint(0, 60))) for _ in range(3000)]
    found = [[] for _ in texts]
    for i, ids in vocabulary.encoded(texts):
        found[i] += ids
    assert found == [library.encode_ordinary(t) for t in texts]


def test_knows_the_same_classes(vocabulary, library):
    every = "".join(chr(i) + " " for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    assert ids_of(vocabulary, every) == library.encode_ordinary(every)


@pytest.mark.parametrize("listed", [bpe.LISTED, 10])
def test_very_long_pre_tokens(vocabulary, library, monkeypatch, listed):
    monkeypatch.setattr(bpe, "LISTED", listed)
    rng = random.Random(6)
    letters = "".join(rng.choices("abcdehinrst", k=100_000))
    for text in ("x" * 50_001, "ab" * 20_000, "é" * 9_999, letters, "-" * 30_000, " " * 5_000 + "a"):
        vocabulary._forget()
        assert ids_of(vocabulary, text) == library.encode_ordinary(text)


def test_ranks_that_fall_while_merging(tmp_path):
    # A merge may make a pair of a lower rank than its own, which then comes first.
    rng = random.Random(7)
    for trial in range(60):
        tokens = {bytes(rng.choices(b"ab", k=rng.randint(2, 6))) for _ in range(rng.randint(1, 12))}
        ranks = [bytes([i]) for i in range(256)] + sorted(tokens, key=lambda _: rng.random())
        path = tmp_path / f"{trial}"
        path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(ranks)))
        own = load_vocabulary(str(path), r"\p{L}+")
        pieces = [bytes(rng.choices(b"ab", k=rng.randint(1, 40))) for _ in range(30)]
        pieces = [p for p in pieces if p not in own.ranks]
        parts, cuts = own.merged(pieces)
        found = [parts[a:b] for a, b in zip(cuts, cuts[1:])]
        assert found == [by_hand(own.ranks, p) for p in pieces]


def test_queue_gives_the_lowest_rank():
    rng, queue, held = random.Random(8), RankQueue(50_000), {}
    for _ in range(2000):
        if held and rng.random() < 0.5:
            lowest = min(held)
            assert queue.first() == lowest
            start, end, late = queue.take(lowest)
            assert (start, end) == (0, 0) and sorted(late) == sorted(held.pop(lowest))
        else:
            rank = rng.choice([rng.randrange(50_000), rng.randrange(70), 49_999])
            position = rng.randrange(1000)
            held.setdefault(rank, []).append(position)
            if rank not in queue.late:
                queue.mark(rank)
            queue.late.setdefault(rank, []).append(position)
    while held:
        lowest = queue.first()
        assert lowest == min(held)
        held.pop(lowest)
        queue.take(lowest)
    assert queue.first() == -1


def test_forgetting_changes_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 200)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 7)
    text = " ".join(f"word{i % 37} and {i}" for i in range(500))
    assert ids_of(vocabulary, text) == library.encode_ordinary(text)


def expected(library, key, text):
    ids = library.encode_ordinary(text or "")
    told = ",".join(map(str, ids)).encode()
    content = (text or "").encode()
    return key, len(ids), hashlib.sha256(told).hexdigest(), hashlib.sha256(content).hexdigest()


def test_digests(spark, vocabulary, library):
    rows = [tuple(r) for r in token_digests(with_clashing_names(docs(spark)), vocabulary).collect()]
    wanted = [expected(library, r[0], r[1]) for r in AWKWARD]
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)
    path = "/root/testdata/sf0.001/documents.parquet"
    found = token_digests(spark.read.parquet(path), vocabulary).collect()
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{path}'").fetchall()
    assert sorted(map(tuple, found)) == sorted(expected(library, *t) for t in texts)


def test_tokens_and_back(spark, vocabulary, library):
    df = docs(spark).withColumn("tokens", F.lit("another column"))
    coded = encode(df, vocabulary)
    assert coded.columns == [*df.columns, "tokens_"]
    for row in decode(coded, vocabulary, "tokens_").collect():
        if row["text"] is None:
            assert row["tokens_"] is None and row["decoded"] is None
        else:
            assert row["tokens_"] == library.encode_ordinary(row["text"])
            assert row["decoded"] == row["text"].encode()
    assert encode(docs(spark, []), vocabulary).collect() == []


def test_bytes_that_are_no_text(spark, vocabulary):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    row = token_digests(df, vocabulary).first()
    assert row["decoded_sha256"] == hashlib.sha256("a�b".encode()).hexdigest()


def test_a_file_that_is_no_vocabulary(tmp_path, monkeypatch):
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError, match="no token for the bytes"):
        load_vocabulary(str(path), r".")
    monkeypatch.setattr(bpe, "VOCABULARY_BYTES", 3)
    with pytest.raises(ValueError, match="larger"):
        load_vocabulary(str(path), r".")
