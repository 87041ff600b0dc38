"""Every registered operator query and the pipeline on the smallest tables."""

import sys

import pytest

import corpus_pipeline
from conftest import SF_SMALL
from helpers import duck_rows, rows_of

COLUMNS = {
    "op1": {"doc_id", "held_out", "score", "predicted"},
    "op2": {"doc_id", "size", "source_size", "target", "taken"},
    "op3": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op4": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op5": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op6": {"doc_id", "n_lines", "n_removed", "kept_sha256"},
    "op7": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op8": {"doc_id", "n_shingles", "component_id", "kept"},
    "op9": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op13": {"doc_id", "held_out", "lang_pred", "score"},
    "op10": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
}


@pytest.mark.parametrize("name", sorted(n for n in corpus_pipeline.LLM_QUERIES if n.startswith("op")
                                         and n.split("_")[0] not in ("op11", "op12")))  # rankings, compared below
def test_query_returns_its_whole_table(spark, name):
    got = corpus_pipeline.LLM_QUERIES[name](spark, SF_SMALL)
    assert COLUMNS[name.split("_")[0]] <= set(got.columns)
    table = "pages" if name.startswith("op10_") else "documents"
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(corpus_pipeline.LLM_ORACLES))
def test_query_matches_sql(spark, duck, name):
    expected, names = duck_rows(duck, corpus_pipeline.LLM_ORACLES[name])
    got = corpus_pipeline.LLM_QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == names and rows_of(got) == expected


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL), name)
        assert docs.columns == columns
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "mix_sources":
            assert len(ids) == len(set(ids)) <= before
            before = len(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert len(last) == len(ids) and all(len(r.ids) == r.n_tokens for r in last)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    empty = corpus_pipeline.materialize(docs.limit(0), "none")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_operators_do_not_need_the_registry():
    assert "ember.plans" not in {m for m in sys.modules if m.startswith("ember.llm")}
