"""The pipeline's stages and the registered queries of this package."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import check
import corpus_pipeline
from panelwright.llm import catalog
from panelwright.session import cut_lineage
from tests.llm import fixtures

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert check.compare(catalog.QUERIES[name](spark, SF), check.duck(SF), catalog.ORACLES[name]) is None


def test_everything_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in catalog.QUERIES}
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = cut_lineage(stage(spark, docs, SF), f"test-{name}")
        if name == "pack":
            assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)
            break
        assert out.columns == docs.columns
        n = out.count()
        assert 0 < n and (n <= before or name == "mix")
        docs, before = out, n


@pytest.mark.parametrize("data", [None, []])
def test_stages_take_awkward_tables(spark, data):
    docs = fixtures.documents(spark, data)
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF), f"test-{name}")
    assert (docs.count() > 0) == (data is None)
