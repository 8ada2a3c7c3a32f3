"""The prefix trie against a plain brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from guidepost.llm import spillqueue
from guidepost.llm.prefix_trie import conversation_trie, ordered_turns
from guidepost.llm.spillqueue import SpillingQueue

TURNS = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            item = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, item, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        yield c, tuple(own.get(c - c % 20, [])[:h] + turns[h:])


def brute(rows):
    convs = dict(rebuilt(rows))
    members = {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[x] for x in children.get(node, [])]
        words = len(node[-1][1].split()) if node else 0
        saved = (len(members[node]) - 1) * words + sum(s for _, s in below)
        totals[node] = (sum(n for n, _ in below) or 1, saved)
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if convs[c] == node)
        parent = min(members[node[:-1]]) if node else None
        yield (
            min(own), len(node), parent, len(own), len(children.get(node, [])), *totals[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        )


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


def made(rng, convs):
    """Conversations that often go on alike, some very long, some that all end in one node."""
    for c in convs:
        kind = rng.random()
        size = 40 if kind < 0.03 else rng.randint(0, 6)
        for turn in range(size):
            alike = kind > 0.6 or rng.random() < 0.5
            text = f"turn {turn} again" if alike else f"turn {turn} of its own {rng.random()}"
            yield c, turn, ("user", "assistant")[turn % 2], text


@pytest.mark.parametrize(("weight", "in_memory"), [(1 << 16, 1 << 18), (40, 3), (6, 1)])
def test_equals_brute_force(spark, weight, in_memory):
    rows = list(made(random.Random(weight), range(300)))
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    found = conversation_trie(df, shard_weight=weight, in_memory=in_memory).collect()
    assert bag(found) == bag(brute(rows))


AWKWARD = [
    (1, None, None, None),
    (1, None, "", ""),  # the same turn once more
    (1, 0, "user", "a tie"),
    (1, 0, "user", "another text at the same turn"),
    (0, 5, "user", "x" * 100_000),
    (0, 6, "assistant", "one two  three\tfour\n"),
    (None, 1, "user", "no conversation"),
    (21, 0, "ab", "c"),
    (22, 0, "a", "bc"),
    (23, 0, None, ""),
    (41, 0, "user", "only turn"),
    (-3, 0, "user", "a number below zero"),
]


def test_awkward_rows(spark):
    df = spark.createDataFrame(AWKWARD, TURNS).repartition(3)
    for name in ("conv", "depth", "a", "b", "item", "words", "size", "first", "TURN_"):
        df = df.withColumn(name, F.lit(7))
    assert bag(conversation_trie(df).collect()) == bag(brute(AWKWARD))


def test_empty_table(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_trie(empty).collect() == []
    alone = spark.createDataFrame([(None, 1, "user", "x")], TURNS)
    assert conversation_trie(alone).collect() == []


def test_a_long_conversation_is_named_in_stretches(spark, monkeypatch):
    monkeypatch.setattr("guidepost.llm.prefix_trie.STRETCH", 4)
    monkeypatch.setattr("guidepost.llm.prefix_trie.ENDS_BLOCK", 8)
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 112) for t in range(30)]
    rows += [(c, t, "user", f"turn {t}") for c in range(200, 240) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS)
    assert bag(conversation_trie(df, shard_weight=64).collect()) == bag(brute(rows))


def test_positions(spark):
    df = spark.createDataFrame([(5, t, "u", str(t)) for t in (7, 3, None, 9)], TURNS)
    found = ordered_turns(df).orderBy("position").collect()
    assert [r["position"] for r in found] == [1, 2, 3, 4] and {r["size"] for r in found} == {4}


def test_queue_spills_and_merges(monkeypatch):
    monkeypatch.setattr(spillqueue, "MOST_RUNS", 3)
    rng, queue, held = random.Random(3), SpillingQueue(5), []
    for _ in range(2000):
        if held and rng.random() < 0.4:
            held.sort()
            assert queue.least() == held[0] and queue.pop() == held.pop(0)
        else:
            held.append((rng.randint(0, 50), rng.randint(0, 5)))
            queue.push(held[-1])
    assert [queue.pop() for _ in range(len(held))] == sorted(held)
    assert queue.least() is None and queue.spilled > 3
