"""Merkle manifests against a plain brute force."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from guidepost.llm.manifest import manifest, verified_manifest
from tests.llm.fixtures import AWKWARD, docs, with_clashing_names


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    told = (row[0], row[3], row[2], row[4], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))


def tree(leaves, arity):
    """The root, and for each leaf its (slot, run) on every level."""
    paths = [[] for _ in leaves]
    nodes, below = list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        cuts = range(0, len(nodes), arity)
        for a in cuts:
            for slot, owned in enumerate(below[a : a + arity]):
                for i in owned:
                    paths[i].append((slot, nodes[a : a + arity]))
        below = [sum(below[a : a + arity], []) for a in cuts]
        nodes = [sha(*nodes[a : a + arity]) for a in cuts]
    return nodes[0], paths


def brute(rows, arity=8):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1]))
    built = [tree([leaf_of(r, r[1]) for r in sorted(groups[g], key=order)], arity) for g in names]
    root, tops = tree([subroot for subroot, _ in built], arity)
    for name, (subroot, paths), top in zip(names, built, tops):
        for row, path in zip(sorted(groups[name], key=order), paths):
            text = row[1]
            if row[0] is not None and text and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node, told = leaf_of(row, text), ""
            for slot, run in path + top:
                node = sha(*run[:slot], node, *run[slot + 1 :])
                told += "".join(run[:slot] + run[slot + 1 :])
            own = leaf_of(row, row[1])
            yield row[0], own, subroot, root, sha(told), node, node == root


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("arity", [2, 8])
def test_awkward_rows(spark, arity):
    found = verified_manifest(with_clashing_names(docs(spark)), arity=arity)
    assert bag(found.collect()) == bag(brute(AWKWARD, arity))


def test_runs_of_every_length(spark):
    rows = [(i, f"Text {i}", f"l{i % 11}" if i < 150 else "big", "s", i) for i in range(230)]
    found = verified_manifest(docs(spark, rows, 7)).collect()
    assert bag(found) == bag(brute(rows))
    tampered = {r["doc_id"] for r in found if not r["verified"]}
    assert tampered == {i for i in range(230) if zlib.crc32(str(i).encode()) % 3 == 0}


def test_one_row_is_its_own_root(spark):
    (row,) = verified_manifest(docs(spark, [(7, "no capitals", None, "s", 1)])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"]
    assert row["proof_sha256"] == hashlib.sha256(b"").hexdigest() and row["verified"]


def test_manifest_keeps_all_columns(spark):
    df = docs(spark).withColumn("leaf", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    df = with_clashing_names(df).withColumn("tree", F.lit(1)).withColumn("root", F.lit(2))
    found = manifest(df, "doc_id", "lang")
    assert found.columns == [*df.columns, "subroot", "root_", "path"]
    assert found.count() == len(AWKWARD)
