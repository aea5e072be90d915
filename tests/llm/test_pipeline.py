"""The stages on the smallest tables, each against its operator's report, and the registered queries against SQL."""

import os

import pytest
from oracle import compare, duck

import corpus_pipeline
from herdframe.llm import decontaminate, quality, similar
from herdframe.llm.queries import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    wanted = [
        lambda d: ids(quality.classify(d, read("labels")).filter("predicted = 1")),
        lambda d: ids(similar.jaccard_join(d).filter("kept")),
        lambda d: sorted(set(ids(d)) - set(ids(decontaminate.find_leaks(d, read("benchmark"))))),
    ]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < 3:
            assert ids(out) == wanted[k](docs)
            assert 0 < out.count() <= docs.count()
        docs = out
    assert docs.count() == corpus_pipeline.run(spark, FOLDER).count()


def folder_with(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, "some words without an id", "en", "web", 24), (None, None, None, None, None), (10**9, None, "en", None, None), (10**9 + 1, "", "en", "web", 0), (10**9 + 2, " ", "en", "x", 1)]
    odd = spark.createDataFrame(odd, docs.schema)
    names = ("cls", "row", "key", "held_out", "component", "copies", "n", "label", "bucket", "score", "quality")
    docs = docs.unionByName(odd).unionByName(odd).selectExpr("*", *[f"'{c}' as `{c}`" for c in names])
    folder = folder_with(spark, tmp_path / "odd", docs)
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.cut_lineage(stage(spark, kept, folder))
        assert kept.columns == docs.columns and kept.filter(" or ".join(f"`{c}` <> '{c}'" for c in names)).isEmpty()
    out = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert out.count() == kept.count() > 0


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    assert corpus_pipeline.run(spark, folder_with(spark, tmp_path / "none", docs)).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert compare(df, duck(FOLDER), SQL[name]) is None
    else:
        assert len(df.take(1)) == 1
