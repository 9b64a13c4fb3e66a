"""The registered queries of the operators and the pipeline on the smallest tables."""

import pytest
from compare import ordered
from conftest import SF_DIR

import corpus_pipeline
from obs_engine.llm.oracles import ORACLES
from obs_engine.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    got = ordered([tuple(r) for r in df.collect()], df.columns)
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == ordered(cursor.fetchall(), names)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_pipeline_keeps_what_each_stage_keeps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF_DIR)
        assert made.columns == columns, name
        docs = spark.createDataFrame(made.collect(), made.schema)
        assert 0 < docs.count() <= before
        before = docs.count()
    pieces = corpus_pipeline.pack(spark, docs, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().count() == before
