"""The registered queries: oracles, the pipeline, native plans."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tessera.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    from check_oracle import compare, duckdb_connection
    ok, message = compare(QUERIES[name](spark, SF), duckdb_connection(SF), ORACLE[name])
    assert ok, message


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert [f.__module__.rsplit(".", 1)[1] for _, f in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "jaccard_join", "decontaminate", "sentencepiece_fst"]


@pytest.mark.parametrize("name", ["op3_decontamination", "op5_url_lists", "op7_personal_data", "op10_quality_rules"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in found]
    assert 0 < len(ids) == len(set(ids)) < docs.count()
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in found)
