"""The pipeline's stages and the registered queries."""

import __spark_entry__
import corpus_pipeline
from cartlens.llm import registry
from tests.llm.cases import awkward

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, seen = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SMALL).persist()
        assert rows.schema.names == docs.schema.names and [f.dataType for f in rows.schema] == [f.dataType for f in docs.schema]
        seen.append(rows.count())
    assert seen[0] > seen[1] > seen[2] >= seen[3] > 0
    kept = {r.doc_id for r in rows.select("doc_id").collect()}
    assert kept <= {r.doc_id for r in docs.select("doc_id").collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, rows, SMALL).collect()
    assert len(last) == seen[-1] and all(len(r.ids) == 4 * r.n_tokens for r in last)


def test_stages_take_awkward_rows(spark):
    rows = awkward(spark)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SMALL).persist()
        assert rows.count() > 0


def test_registration():
    names = set(__spark_entry__.queries())
    assert {*registry.queries(), "pipeline"} <= names
    assert {n.split("_")[0] for n in registry.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(registry.oracles()) <= set(registry.queries())
