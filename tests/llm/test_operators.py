"""Each operator against a brute-force version or an exact property."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from guidepost.llm import batches as batches_module
from guidepost.llm import chunks, decontaminate, pii, simhash, suffix_dedup, suffixes, vantage
from guidepost.llm.components import components
from guidepost.llm.language import FEATURES, codewords, fit, identify
from guidepost.llm.mixing import mix, mix_report
from guidepost.llm.quality_model import quality
from guidepost.llm.quality_rules import BAD, GOOD, NONE, judge, posteriors
from guidepost.llm.sql import ORACLES
from guidepost.llm.textops import grams, words_of
from guidepost.llm.toxicity import _word_counts, discount, toxicity, without_copies
from tests.llm.fixtures import benchmark, docs

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def numbered(spark, texts, parts=5):
    return docs(spark, [(i, t, None, None, None) for i, t in enumerate(texts)], parts)


# 1. SimHash


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(text)
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(points):
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        near = np.flatnonzero(np.bitwise_count(points[i + 1 :] ^ points[i]) <= 2)
        for j in near.tolist():
            a, b = find(i), find(i + 1 + j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def test_simhash_equals_brute_force(spark, table, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 64)  # many shards and boundaries
    rows = simhash.near_duplicates(table("documents")).orderBy("doc_id").collect()
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    assert all(int(r["fingerprint"], 16) == slow_fingerprint(texts[r["doc_id"]]) for r in rows[:80])
    points = np.array([int(r["fingerprint"], 16) for r in rows], np.uint64)
    names = [rows[i]["doc_id"] for i in slow_components(points)]
    assert [r["component_id"] for r in rows] == names
    assert len(set(names)) < len(names)
    kept = simhash.drop_near_duplicates(table("documents")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(names))


def test_links_of_a_dense_group_are_all_followed(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 50)
    rng = np.random.default_rng(3)
    masks = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))
                      for _ in range(600)], np.uint64)
    points = np.unique(np.uint64(0x0123456789ABCDEF) ^ masks)
    points = np.concatenate([points, rng.integers(0, 2**64, 300, dtype=np.uint64)])
    points = np.unique(points)
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "point long")
    found = {r["node"]: r["root"] for r in components(simhash.links(frame, 2)).collect()}
    groups = [found.get(int(p), int(p)) for p in points.view(np.int64)]
    expected = slow_components(points)
    assert len(set(zip(groups, expected))) == len(set(groups)) == len(set(expected))


def test_route_brings_near_points_together():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    points = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40)]))
    tree, leaves = vantage.build(points, 20, 2)
    assert leaves > 10
    met = set()
    for _, at, guest in vantage.route(tree, points, np.zeros(len(points), bool), 2):
        for a, b in vantage.pairs_within(points[at], guest, 2):
            met |= {(min(i, j), max(i, j)) for i, j in zip(at[a].tolist(), at[b].tolist())}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    assert met == {(i, j) for i, j in np.argwhere(near).tolist() if i < j}


def test_components_of_a_long_path(spark):
    edges = [(i + 1, i) for i in range(60)] + [(101, 100)]
    rows = components(spark.createDataFrame(edges, "high long, low long")).collect()
    assert {r["node"]: r["root"] for r in rows} == {i: 0 for i in range(1, 61)} | {101: 100}


# 2, 8, 9. Learned operators, by held-out accuracy


def test_toxicity_on_held_out_rows(table):
    found = toxicity(table("documents"), table("labels"))
    rows = found.join(table("labels"), "doc_id").where("held_out").collect()
    flagged = [r["toxic"] for r in rows if r["predicted"]]
    assert len(rows) > 80 and sum(flagged) >= 7 and sum(flagged) >= 0.9 * len(flagged)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


@pytest.mark.parametrize("size, least", [("sf0.01", 9), ("sf0.1", 90)])
def test_rare_toxic_expressions_count(spark, size, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/{size}/{n}.parquet") for n in ("documents", "labels"))
    insults = "idiot trash scum moron clown loser stupid pathetic worthless disgusting".split()
    insulting = F.arrays_overlap(F.split(F.lower("text"), "[^a-z]+"), F.array(*map(F.lit, insults)))
    scored = toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    rows = scored.join(docs.select("doc_id", insulting.alias("insulting")), "doc_id").collect()
    assert all(r["predicted"] for r in rows if r["insulting"])
    assert sum(r["predicted"] for r in rows if r["toxic"]) >= least
    clean = [r["predicted"] for r in rows if not r["toxic"] and not r["insulting"]]
    assert sum(clean) <= 0.015 * len(clean)


@pytest.mark.parametrize("once, twice", [(0, 0), (0, 5), (5, 0), (1000, 100)])
def test_discounts_are_absolute(once, twice):
    assert 0 < discount(once, twice) < 1


def test_word_counts_grow_with_the_corpus(spark):
    rows = [(" ".join(f"w{i}x{j}" for j in range(10_000)) + " again",) for i in range(20)]
    counted = _word_counts(spark.createDataFrame(rows, "text string").repartition(4), "text")
    assert counted.count() == 200_001
    assert sorted({r["n"] for r in counted.select("n").distinct().collect()}) == [1, 20]


def test_unlike_texts_are_no_copies(spark):
    rows = [(i, f"the same few words here {w}", 0) for i, w in enumerate("abcdefghijklmnop")]
    rows += [(20, "bad dog", 1), (21, "good", 0), (22, "Bad, dog!", 1), (23, "bad dog", 0)]
    train = spark.createDataFrame(rows, "id long, text string, label int")
    kept = without_copies(train.selectExpr("id", "CAST(text AS binary) text", "label"))
    found = [(r["label"], bytes(r["text"]).decode()) for r in kept.collect()]
    assert len(found) == len(rows) - 1  # 22 says what 20 says, under the same label
    assert {t for _, t in found} >= {t for i, t, _ in rows if i not in (20, 22)}


def test_language_on_held_out_rows(table):
    rows = identify(table("documents")).join(table("documents"), "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_quality_on_held_out_rows(table):
    found = quality(table("documents"), table("labels"))
    rows = found.join(table("labels"), "doc_id").where("held_out").collect()
    assert sum(r["quality"] == r["predicted"] for r in rows) >= 0.95 * len(rows) > 60


def test_scores_do_not_follow_labels_or_sources(spark, table):
    found = identify(table("documents"))
    other = table("documents").selectExpr(
        "doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS string)) % 4 = 2 THEN 'xx' ELSE lang END AS lang"
    )
    assert sorted(map(repr, found.collect())) == sorted(map(repr, identify(other).collect()))


@pytest.mark.parametrize("count", [2, 3, 4, 6, 9, 20])
def test_codewords_differ(count):
    code = codewords(count)
    apart = [int((code[i] != code[j]).sum()) for i in range(count) for j in range(i)]
    assert min(apart) >= (1 if count == 2 else 2)


def test_many_copies_do_not_thin_out_the_sample(spark):
    rng = random.Random(9)
    letters = {"aa": "abcde", "bb": "vwxyz"}
    words = lambda lang: " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(30))
    rows = [(i, words(lang), lang, "s", 1) for i, lang in enumerate(["aa", "bb"] * 60)]
    rows += [(1000 + i, rows[0][1], "aa", "s", 1) for i in range(6000)]
    found = identify(docs(spark, rows), rows=200).where("doc_id < 1000").collect()
    assert {r["lang_pred"] == ["aa", "bb"][r["doc_id"] % 2] for r in found} == {True}


def test_ambiguous_between_two_languages():
    rng = np.random.default_rng(1)
    centers = np.abs(rng.normal(size=(3, FEATURES))).astype(np.float32)
    centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    rows = np.repeat(centers, 30, axis=0)
    model = fit(rows, [n for n in "abc" for _ in range(30)])
    middle = (centers[0] + centers[1]) / np.linalg.norm(centers[0] + centers[1])
    best, _, close = model.decoded(np.stack([*centers, middle]))
    assert [model.names[i] for i in best[:3]] == list("abc")
    assert close.tolist() == [False, False, False, True]


# 3. Personal data


def slow_spans(text):
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    ip = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"

    def luhn(value):
        digits = [int(c) for c in value if c.isdigit()][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        return 13 <= len(digits) <= 19 and total % 10 == 0

    return {
        "email": [m.span() for m in re.finditer(email, text)],
        "ip": [m.span() for m in re.finditer(ip, text) if max(map(int, m[0].split("."))) <= 255],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if luhn(m[0])],
        "phone": [
            m.span()
            for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15
        ],
    }


def test_base_spans_equal_the_plain_patterns(table):
    rng = random.Random(1)
    made = ["".join(rng.choice("aB1.@@-+ ()é2%50") for _ in range(rng.randint(0, 40)))
            for _ in range(20_000)]
    made += ["".join(rng.choice("0123456789.. -+") for _ in range(30)) for _ in range(20_000)]
    made += [r["text"] for r in table("documents").collect()]
    for text in made:
        assert pii.base_spans(text) == slow_spans(text), text


@pytest.mark.parametrize(
    ("text", "kind", "piece"),
    [
        ("to john.doe [at] mail (dot) example (dot) com now", "email",
         "john.doe [at] mail (dot) example (dot) com"),
        ("bob at example dot com", "email", "bob at example dot com"),
        ("ask john at example [dot] com.", "email", "john at example [dot] com"),
        ("john.doe at example (dot) org", "email", "john.doe at example (dot) org"),
        ("jоhn@exаmple.com!", "email", "jоhn@exаmple.com"),
        ("mail jane​.doe@example.org, bye", "email", "jane​.doe@example.org"),
        ("call +one two three five five five zero one two", "phone",
         "+one two three five five five zero one two"),
        ("ip １２.３.４.５ x", "ip", "１２.３.４.５"),
        ("pay four" + " one" * 15 + " now", "card", "four" + " one" * 15),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, piece):
    base = pii.base_spans(text)
    added = pii.added_spans(text, base)
    assert [text[a:b] for a, b in added[kind]] == [piece]
    assert pii.redacted(text) == text.replace(piece, f"<{kind.upper()}>")


@pytest.mark.parametrize("text", ["look at example.com", "look at example.com and (dot) here", "to oned at this dot", "one two", "at dot"])
def test_plain_text_is_no_disguise(text):
    assert not any(pii.added_spans(text, pii.base_spans(text)).values())
    assert pii.redacted(text) == text


# 4. Decontamination


def slow_tiles(item, doc, least):
    """Greedy string tiling as published: the longest unmarked match again and again."""
    used_item, used_doc = [False] * len(item), [False] * len(doc)
    while True:
        best = None
        for p in range(len(item)):
            for t in range(len(doc)):
                k = 0
                while (p + k < len(item) and t + k < len(doc) and item[p + k] == doc[t + k]
                       and not used_item[p + k] and not used_doc[t + k]):
                    k += 1
                if k >= least and (best is None or k > best[0]):
                    best = (k, p, t)
        if best is None:
            return sum(used_item)
        k, p, t = best
        used_item[p : p + k] = [True] * k
        used_doc[t : t + k] = [True] * k


def test_tiling_equals_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        item = "".join(rng.choice("ab") for _ in range(rng.randint(0, 25)))
        doc = "".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))
        index = decontaminate.Index.of([(1, " ".join(item))])
        found = decontaminate.coverages(index, " ".join(doc))
        least = max(1, min(decontaminate.TILE, len(item)))
        share = slow_tiles(item, doc, least) / max(1, len(item))
        assert found.get(0, 0.0) == pytest.approx(share), (item, doc)


def test_repeated_tokens_make_no_product_of_seeds(monkeypatch):
    rng = random.Random(4)
    cases = [(rng.choices("ab", (9, 1), k=rng.randint(1, 30)), rng.choices("abc", (9, 1, 1), k=40)) for _ in range(80)]
    for pairs in (0, 1000):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        for item, doc in cases:
            index = decontaminate.Index.of([(1, " ".join(item))])
            found = decontaminate.coverages(index, " ".join(doc)).get(0, 0.0)
            least = min(decontaminate.TILE, len(item))
            assert found == pytest.approx(slow_tiles(item, doc, least) / len(item))
    monkeypatch.undo()
    began = time.process_time()
    index = decontaminate.Index.of([(1, "same " * 3000)])
    assert decontaminate.coverages(index, "same " * 6000) == {0: 1.0}
    assert time.process_time() - began < 3


def test_short_items_are_found(spark):
    items = [(1, "two words"), (2, "Alone"), (3, "..."), (4, "not in any text")]
    texts = ["here two, WORDS are", "two other words", "alone", "", "words two"]
    rows = decontaminate.contamination(numbered(spark, texts), benchmark(spark, items)).collect()
    assert {r["doc_id"]: r["items"] for r in rows} == {0: [1], 1: [], 2: [2], 3: [], 4: []}


def test_reordered_and_edited_passages_are_caught(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)  # several blocks
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    items = [(i, " ".join(words[i * 30 : i * 30 + 30])) for i in range(10)]
    halves = " ".join(words[15:30] + ["between"] * 9 + words[:15])
    edited = " ".join(w if i % 9 else "other" for i, w in enumerate(words[30:60]))
    texts = [halves, "see: " + edited.upper(), " ".join(words[300:390]), items[2][1] + " " + items[5][1]]
    rows = decontaminate.contamination(numbered(spark, texts), benchmark(spark, items)).collect()
    found = {r["doc_id"]: sorted(r["items"]) for r in rows}
    assert found == {0: [0], 1: [1], 2: [], 3: [2, 5]}
    kept = decontaminate.drop_contaminated(numbered(spark, texts), benchmark(spark, items)).collect()
    assert [r["doc_id"] for r in kept] == [2]


def test_all_planted_items_are_found(table):
    items = {r["item_id"]: r["text"] for r in table("benchmark").collect()}
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    rows = decontaminate.contamination(table("documents"), table("benchmark")).collect()
    found = {r["doc_id"]: set(r["items"]) for r in rows}
    for doc, text in texts.items():
        assert {i for i, t in items.items() if t in text} <= found[doc]


# 5. Mixing


def test_mixing_equals_its_sql(table):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS FROM '{SF_DIR}/documents.parquet'")
    expected = connection.execute(ORACLES["op5_mixing"]).fetchall()
    assert sorted(map(tuple, mix_report(table("documents")).collect())) == sorted(expected)


def test_no_text_is_taken_more_often_than_allowed(spark):
    # The second source stops at twice its size; its texts without words once got a third copy.
    rows = [(i, "word " * 50, "en", "a", 1) for i in range(30)]
    rows += [(100 + i, "" if i % 2 else None, "en", "b", 0) for i in range(40)]
    rows += [(200 + i, "one two", "en", "b", 1) for i in range(3)]
    found = mix_report(docs(spark, rows)).collect()
    assert max(r["copies"] for r in found) == 2
    assert {r["copies"] for r in found if r["doc_id"] >= 100} == {2}
    counts = Counter(r["doc_id"] for r in mix(docs(spark, rows)).collect())
    assert max(counts.values()) == 2 and counts == {r["doc_id"]: r["copies"] for r in found if r["copies"]}


def test_sources_come_near_their_targets(spark, table):
    report = mix_report(table("documents")).collect()
    sources = {r["doc_id"]: r["source"] for r in table("documents").collect()}
    taken, largest = Counter(), Counter()
    for r in report:
        assert r["copies"] <= 2
        source = sources[r["doc_id"]], r["target"]
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    assert all(abs(taken[s] - s[1]) <= largest[s] for s in taken) and len(taken) == 20
    mixed = mix(table("documents"))
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(
        {r["doc_id"]: r["copies"] for r in report if r["copies"]}
    )


def test_equal_points_are_taken_together(spark):
    rows = [(1, "a b c", None, "s", 5)] * 10 + [(2, "d e", None, None, 3), (3, "f " * 30, None, "t", 60)]
    copies = {(r["doc_id"], r["copies"]) for r in mix_report(docs(spark, rows)).collect()}
    assert len(copies) == 3


# 6. Chunks


def slow_chunks(texts, least_run):
    cut = []
    for raw in texts:
        ends = chunks.chunk_ends(np.frombuffer(raw, np.uint8)).tolist()
        cut.append([raw[a:b] for a, b in zip([0, *ends], ends)])
        assert b"".join(cut[-1]) == raw
    count = Counter(c for own in cut for c in own)
    seen, kept = set(), []
    for own in cut:
        gone = []
        for c in own:
            gone.append(count[c] > 1 and c in seen)
            seen.add(c)
        out, i = b"", 0
        while i < len(own):
            j = i
            while j < len(own) and gone[j] == gone[i]:
                j += 1
            piece = b"".join(own[i:j])
            out += b"" if gone[i] and len(piece) >= least_run else piece
            i = j
        kept.append(out)
    return kept


@pytest.mark.parametrize("least_run", [0, 64])
def test_chunks_equal_brute_force(table, monkeypatch, least_run):
    monkeypatch.setattr(batches_module, "BATCH_BYTES", 200_000)
    texts = [r["text"].encode() for r in table("documents").orderBy("doc_id").collect()]
    found = chunks.without_repeated_chunks(table("documents"), least_run=least_run)
    rows = found.orderBy("doc_id").collect()
    assert [bytes(r["kept"]) for r in rows] == slow_chunks(texts, least_run)
    assert sum(r["n_removed"] for r in rows) > 0


def test_gear_hash_rolls():
    buf = np.frombuffer(random.Random(5).randbytes(300), np.uint8)
    value, mask = 0, (1 << 16) - 1
    found = chunks.gear(buf)
    for i, byte in enumerate(buf.tolist()):
        value = (value << 1) + int(chunks.GEAR[byte])
        assert int(found[i]) & mask == value & mask


def test_insertion_changes_few_chunks():
    raw = random.Random(6).randbytes(20_000)
    other = raw[:7000] + b"inserted" + raw[7000:]
    cut = []
    for text in (raw, other):
        ends = chunks.chunk_ends(np.frombuffer(text, np.uint8)).tolist()
        cut.append({text[a:b] for a, b in zip([0, *ends], ends)})
    assert len(cut[0] - cut[1]) <= 4


def test_a_chunk_is_never_longer_than_allowed():
    ends = chunks.chunk_ends(np.zeros(100_000, np.uint8) + 65)
    assert ends[-1] == 100_000 and np.diff(np.concatenate([[0], ends])).max() <= chunks.MOST


# 7. Suffixes


def slow_removal(texts, length=400):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        found.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def cut_out(spark, texts):
    rows = suffix_dedup.repeated_substrings(numbered(spark, texts)).orderBy("doc_id").collect()
    return [tuple(r[1:5]) for r in rows]


@pytest.fixture()
def small_groups(monkeypatch):
    monkeypatch.setattr(batches_module, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "NAMES_PER_GROUP", 100)
    monkeypatch.setattr(suffix_dedup, "PIECES_BYTES_PER_GROUP", 5_000)


@pytest.mark.parametrize("heavy_bytes", [suffix_dedup.HEAVY_BYTES, 3000])
def test_suffixes_equal_brute_force(spark, small_groups, monkeypatch, heavy_bytes):
    monkeypatch.setattr(suffix_dedup, "HEAVY_BYTES", heavy_bytes)
    rng = random.Random(7)
    base = ["".join(rng.choice("ab") for _ in range(900)) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            a, b = sorted(rng.sample(range(900), 2))
            parts.append(rng.choice(base)[a:b])
        texts.append("".join(parts))
    texts += ["", "a" * 399, "c" * 400, "d" * 401, "e" * 3000, "xyz" * 900, base[0], base[0]]
    found = cut_out(spark, texts)
    assert found == slow_removal([t.encode() for t in texts])
    assert sum(f[1] for f in found) > 0


def test_window_names_see_every_byte():
    rng = np.random.default_rng(13)
    one = rng.integers(0, 256, suffixes.MATCH).astype(np.uint8)
    windows = [one]
    for at in range(suffixes.MATCH):  # each byte changed, and each moved to the place before
        other = one.copy()
        other[at] ^= rng.integers(1, 256)
        windows += [other, np.roll(one, at)]
    buf = np.concatenate([*windows, *windows])
    names = suffixes.window_names(buf, np.arange(len(windows) * 2) * suffixes.MATCH)
    assert (names[: len(windows)] == names[len(windows) :]).all()
    texts = {w.tobytes() for w in windows}
    for k in (0, 1):
        assert len(set(names[:, k].tolist())) == len(texts)


def test_exactly_400_bytes_count_and_399_do_not(spark, small_groups):
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdefgh") for _ in range(400))
    for length in (399, 400):
        texts = [f"{chr(65 + k) * k}{shared[:length]}{chr(97 + k) * (60 - k)}" for k in (9, 17, 23)]
        assert [f[1] for f in cut_out(spark, texts)] == [0 if length < 400 else 400] * 3


def test_matches_do_not_cross_texts(spark, small_groups):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh") for _ in range(700))
    assert [f[1] for f in cut_out(spark, [text[:350], text[350:], "z" + text + "z"])] == [0, 0, 0]


def test_bytes_not_characters(spark, small_groups):
    rng = random.Random(10)
    shared = "".join(rng.choice("äöü漢") for _ in range(190))
    texts = ["1" + shared + "2", "3" + shared + "4"]
    assert cut_out(spark, texts) == slow_removal([t.encode() for t in texts])


def test_difference_cover_has_every_distance():
    cover = suffixes.COVER
    apart = {(a - b) % cover for a in suffixes.RESIDUES for b in suffixes.RESIDUES}
    assert apart == set(range(cover))
    assert cover - 1 + suffixes.TUPLE <= suffixes.MATCH


def test_clashing_names_are_told_apart(monkeypatch):
    rng = np.random.default_rng(11)
    buf = rng.integers(97, 100, 4000).astype(np.uint8)
    buf[2000:2600] = buf[100:700]
    starts = np.arange(len(buf) - suffixes.MATCH + 1)
    honest = suffixes.repeated_windows(buf, starts)
    monkeypatch.setattr(suffixes, "named", lambda b, r: np.zeros(max(0, len(b) - 242), np.uint64))
    assert (suffixes.repeated_windows(buf, starts) == honest).all()
    assert honest.sum() >= 402


# 10. Quality rules


def test_measures_equal_brute_force(table):
    texts = {r["doc_id"]: r["text"] for r in table("documents").collect()}
    for r in judge(table("documents")).collect():
        text = texts[r["doc_id"]]
        words = WORD.findall(text)
        at = defaultdict(list)
        for i in range(len(words) - 7):
            at[tuple(words[i : i + 8])].append(i)
        again = {i + k for own in at.values() if len(own) > 1 for i in own for k in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected = (
            len(words),
            sum(map(len, words)),
            len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)),
            len(again),
        )
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert tuple(r[n] for n in names) == expected
        assert r["base_failed"] == (len(words) < 20 or 100 * len(again) > 30 * len(words))


def test_verdicts_agree_with_labels(table):
    rows = judge(table("documents")).join(table("labels"), "doc_id").collect()
    rows = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.95 * len(rows)


def test_expectation_maximisation_finds_who_can_be_trusted():
    rng = np.random.default_rng(12)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.6])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None])
    votes = np.where(votes, GOOD, BAD)
    votes[rng.random(votes.shape) < 0.2] = NONE
    good, accuracy = posteriors(votes, np.ones(len(votes)), poor=0.3)
    assert np.abs(accuracy.mean(0) - right).max() < 0.05
    assert ((good >= 0.5) == truth).mean() > 0.93


# Shared pieces


def test_words_and_grams():
    words = words_of([b"a bb  a\n", None, b"", b"bb a bb a"])
    assert words.counts().tolist() == [3, 0, 0, 4]
    assert words.hash[0] == words.hash[2] == words.hash[4] and words.hash[1] == words.hash[3]
    keys, at = grams(words.hash, words.text, 2)
    assert at.tolist() == [0, 1, 3, 4, 5]
    assert keys[1] == keys[2] == keys[4] and keys[0] == keys[3]
