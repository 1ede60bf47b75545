"""The stages one after another, and every registered query on the smallest tables."""

from pathlib import Path

import pytest
from cases import awkward, documents

import __spark_entry__ as contract
import corpus_pipeline
from starward.sources.scratch import staged

FOLDER = Path("/root/testdata/sf0.001")


def test_stages_take_awkward_rows_and_keep_the_columns(spark):
    docs = documents(spark, awkward()).select("doc_id", "text", "lang", "source", "n_chars")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, "unused"), name)
        assert docs.columns == columns, name
    rows = {r.doc_id: r.text for r in docs.collect()}
    assert 12 not in rows and 13 not in rows and 16 not in rows  # nothing in them
    assert 21 not in rows  # one sentence over and over
    assert 17 in rows and 18 not in rows  # copies
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "unused").collect()
    assert {r.doc_id for r in packed} == set(rows)
    assert sum(r.length for r in packed) == sum(len(t.encode().split()) + 1 for t in (r.text for r in docs.collect()))


def test_stages_take_an_empty_table(spark):
    docs = documents(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, "unused"), name)
    assert docs.collect() == []


def test_every_operator_is_registered_once():
    names = contract.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(contract.oracle_sql()) <= set(names)


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")
def test_pipeline_runs(spark):
    out = contract.queries()["pipeline"](spark, str(FOLDER))
    assert out.columns[0] == "doc_id" and out.count() > 100
