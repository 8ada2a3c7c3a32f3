"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import functools
import hashlib

import public_tokenizers
import pytest

from guidepost.llm.bpe import load_vocabulary, token_digests
from guidepost.llm.chunks import without_repeated_chunks
from guidepost.llm.decontaminate import contamination, drop_contaminated
from guidepost.llm.language import identify
from guidepost.llm.manifest import verified_manifest
from guidepost.llm.mixing import mix, mix_report
from guidepost.llm.pii import find_personal_data, redact
from guidepost.llm.quality_model import quality
from guidepost.llm.quality_rules import judge
from guidepost.llm.simhash import drop_near_duplicates, near_duplicates
from guidepost.llm.suffix_dedup import repeated_substrings
from guidepost.llm.toxicity import drop_toxic, toxicity
from tests.llm.fixtures import AWKWARD, LONG, benchmark, docs, labels, with_clashing_names

LABELS = [(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, 1, 0), (5, 1, 0), (6, 0, 1), (7, 1, 0), (8, None, None)]
LABELS += [(None, 1, 1), (99, 1, 1)]
ITEMS = [(1, "some words that are in no text at all"), (2, None), (3, ""), (None, "x y z")]


@functools.cache
def vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return load_vocabulary(path, public_tokenizers.PATTERN)


REPORTS = {
    "simhash": near_duplicates,
    "toxicity": lambda df: toxicity(df, labels(df.sparkSession, LABELS)),
    "pii": find_personal_data,
    "decontamination": lambda df: contamination(df, benchmark(df.sparkSession, ITEMS)),
    "mixing": mix_report,
    "chunks": without_repeated_chunks,
    "suffixes": repeated_substrings,
    "language": identify,
    "quality": lambda df: quality(df, labels(df.sparkSession, LABELS)),
    "rules": judge,
    "bpe": lambda df: token_digests(df, vocabulary()),
    "manifest": verified_manifest,
}
STAGES = {
    "toxicity": lambda df: drop_toxic(df, labels(df.sparkSession, LABELS)),
    "near duplicates": drop_near_duplicates,
    "decontamination": lambda df: drop_contaminated(df, benchmark(df.sparkSession, ITEMS)),
    "personal data": lambda df: redact(df, size="n_chars"),
    "mixing": mix,
}


def ids(rows):
    return sorted((row["doc_id"] for row in rows), key=lambda x: (x is None, x))


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_has_a_row_for_each_row(spark, name):
    found = REPORTS[name](docs(spark)).collect()
    assert ids(found) == ids({"doc_id": r[0]} for r in AWKWARD)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_does_not_depend_on_other_columns(spark, name):
    plain = REPORTS[name](docs(spark))
    extra = REPORTS[name](with_clashing_names(docs(spark)))
    assert plain.columns == extra.columns
    key = lambda rows: sorted(map(repr, rows))
    assert key(plain.collect()) == key(extra.collect())


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_of_an_empty_table_is_empty(spark, name):
    assert REPORTS[name](docs(spark, [])).collect() == []


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stage_keeps_all_columns(spark, name):
    df = with_clashing_names(docs(spark))
    found = STAGES[name](df)
    assert found.columns == df.columns
    assert [f.dataType for f in found.schema] == [f.dataType for f in df.schema]
    assert found.count() > 0


@pytest.mark.parametrize("name", sorted(STAGES))
def test_stage_of_an_empty_table_is_empty(spark, name):
    assert STAGES[name](docs(spark, [])).collect() == []


def test_blank_texts_link_and_one_row_stays(spark):
    rows = near_duplicates(docs(spark)).collect()
    blank = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert sorted(r["component_id"] for r in blank) == [2, 2, 2, 2]
    kept = drop_near_duplicates(docs(spark)).collect()
    texts = [r["text"] for r in kept]
    assert texts.count(LONG) == 1 and [r["doc_id"] for r in kept if r["text"] == LONG] == [5]
    assert len([t for t in texts if not (t or "").strip()]) == 1
    assert texts.count(AWKWARD[0][1]) == 1


def test_component_without_ids_has_no_name(spark):
    df = docs(spark, [(None, "a b c d e f", None, None, None)] * 2)
    assert [r["component_id"] for r in near_duplicates(df).collect()] == [None, None]


def test_texts_without_words_score_the_prior(spark):
    rows = {r["doc_id"]: r["score"] for r in REPORTS["toxicity"](docs(spark)).collect()}
    assert rows[2] == rows[3] == rows[4]


def test_without_labels_all_texts_score_alike(spark):
    for found, score in ((toxicity, 0.1), (quality, 0.5)):
        rows = found(docs(spark), labels(spark)).collect()
        assert {round(r["score"], 6) for r in rows} == {score}
    assert drop_toxic(docs(spark), labels(spark)).count() == len(AWKWARD)


def test_texts_without_letters_have_no_language(spark):
    rows = {r["doc_id"]: r for r in identify(docs(spark)).collect() if r["doc_id"] in (2, 3, 4, 8)}
    assert [rows[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3
    assert rows[8]["lang_pred"] != "und"


def test_without_languages_nothing_is_learned(spark):
    df = docs(spark).drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {(r["lang_pred"], r["score"]) for r in identify(df).collect()} == {("und", 0.0)}


def test_null_text_has_no_personal_data_and_stays_null(spark):
    row = find_personal_data(docs(spark)).where("doc_id = 2").first()
    assert row["base_sha256"] == hashlib.sha256(b"").hexdigest() and row["spans"] == ""
    assert redact(docs(spark)).where("doc_id = 2").first()["text"] is None


def test_empty_benchmark_leaves_all_clean(spark):
    found = contamination(docs(spark), benchmark(spark)).collect()
    assert {(r["contaminated"], r["coverage"]) for r in found} == {(False, 0.0)}


def test_texts_without_words_fail_the_base_rule(spark):
    rows = judge(docs(spark)).where("doc_id IN (2, 3, 4)").collect()
    assert {(r["n_words"], r["base_failed"], r["kept"]) for r in rows} == {(0, True, False)}
