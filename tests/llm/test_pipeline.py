"""The pipeline's stages on their own inputs, and registered queries against their SQL."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from llm_cases import frame
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402
from oracle_check import _sorted_rows, oracle_connection  # noqa: E402

from rillstone.llm.registry import ORACLE, QUERIES  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    frame_ = QUERIES[name](spark, sf_dir)
    result = oracle_connection(sf_dir).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame_.columns)
    assert _sorted_rows(frame_.columns, frame_.collect()) == _sorted_rows(columns, result.fetchall())


def test_contract_has_every_query():
    import __spark_entry__ as contract

    names = contract.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        if name != "encoded":
            assert made.columns == COLUMNS
        after = made.count()
        assert 0 < after <= before
        docs, before = corpus_pipeline.stored(made, name), after
    assert docs.where("n_tokens <> size(ids)").count() == 0


def test_stages_take_awkward_rows(spark, sf_dir):
    rows = [(1, None), (2, ""), (None, "some words here"), (None, None), (3, "a " * 40), (4, "a " * 40), (5, "Tiny."), (5, "Tiny.")]
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES[1:]:
        made = stage(spark, docs, sf_dir)
        kept = [r.doc_id for r in made.collect()]
        assert {1, 2, 3, 5} <= set(kept) and kept.count(None) == 2, name
        assert (4 in kept) == (name != "near_duplicates")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_quality_keeps_null_and_empty_texts(spark, sf_dir, monkeypatch):
    def rejecting(docs, model):
        return docs.select(F.struct("*").alias("row"), F.lit(False).alias("accepted"))

    monkeypatch.setattr(corpus_pipeline, "graded", rejecting)
    made = corpus_pipeline.quality(spark, frame(spark, [(1, None), (2, ""), (None, ""), (3, "poor words")]), sf_dir)
    assert sorted(str(r.doc_id) for r in made.collect()) == ["1", "2", "None"]
