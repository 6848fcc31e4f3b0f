"""The pipeline's stages, each on what the one before kept, and the numbered queries' registration."""

import importlib

import corpus_pipeline
from draftlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_all_numbers_are_registered():
    entry = importlib.import_module("__spark_entry__")
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = docs.limit(1).selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars")
    docs.union(extra).union(docs.limit(2)).write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, SF_DIR)
        assert i == 4 or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert 0 < after.count()
        if i < 3:
            assert after.exceptAll(rows).count() == 0
        if name == "exact_copies":
            assert after.count() == after.selectExpr("lower(coalesce(text, ''))").distinct().count()
        before, rows = rows, after
    assert rows.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
