"""The registered queries and the pipeline."""

import inspect

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from guidepost.llm import pii, simhash, toxicity
from guidepost.llm.queries import QUERIES
from guidepost.llm.sql import ORACLES
from tests.helpers import plan_of

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_are_registered():
    assert QUERIES.items() <= queries().items()
    assert ORACLES.items() <= oracle_sql().items()
    assert queries()["pipeline"] is corpus_pipeline.run
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    result = connection.execute(ORACLES[name])
    assert found.columns == [d[0] for d in result.description]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(result.fetchall(), key=repr)


# What the contracts fix, in their order; more columns may follow.
LEADING = {
    "op1_simhash": "doc_id fingerprint component_id",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op5_mixing": "doc_id size source_size target taken",
    "op7_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_language": "doc_id held_out lang_pred score",
    "op9_quality_model": "doc_id held_out score predicted",
    "op10_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op11_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


@pytest.mark.parametrize("name", sorted(LEADING))
def test_leading_columns(spark, name):
    names = LEADING[name].split()
    found = QUERIES[name](spark, "/root/testdata/sf0.001").columns
    assert found[: len(names)] == names


def test_mixing_is_native(spark):
    plan = plan_of(QUERIES["op5_mixing"](spark, SF_DIR))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_stages_call_the_operators_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    before = {r["doc_id"]: r for r in docs.collect()}

    clean = stages["toxicity"](spark, docs, SF_DIR).cache()
    assert clean.columns == COLUMNS
    scored = toxicity.toxicity(docs, labels).collect()
    ordinary = {r["doc_id"] for r in scored if not r["predicted"]}
    assert {r["doc_id"] for r in clean.collect()} == ordinary

    single = stages["near_duplicates"](spark, clean, SF_DIR).cache()
    assert single.columns == COLUMNS
    groups = {r["component_id"] for r in simhash.near_duplicates(clean).collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(groups)

    apart = stages["decontamination"](spark, single, SF_DIR).cache()
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert apart.columns == COLUMNS
    assert not any(t in r["text"] for r in apart.collect() for t in items)
    assert 0 < single.count() - apart.count() < 0.1 * single.count()

    private = stages["personal_data"](spark, apart, SF_DIR).cache()
    assert private.columns == COLUMNS
    for r in private.collect():
        assert "@mail" not in r["text"] and r["n_chars"] == len(r["text"])
        assert r["text"] == pii.redacted(before[r["doc_id"]]["text"])

    mixed = stages["mixing"](spark, private, SF_DIR)
    assert mixed.columns == COLUMNS
    counts = mixed.groupBy("doc_id").count().collect()
    assert {r["count"] for r in counts} <= {1, 2}
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, mixed.collect()))
