"""Every numbered query on a small folder: columns and rows of its contract, mapped from the operators and back."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from draftlake.llm.queries import QUERIES, held_out, items_digest

SF_DIR = "/root/testdata/sf0.001"
# Columns that each query returns at least, and the table that it has one row of each of (None: another number of rows).
CONTRACT = {
    "op1": ("page_id url text n_chars", "pages"), "op2": ("doc_id start n_tokens ids_crc32", "documents"),
    "op3": ("doc_id n_words n_hit n_items items_sha256 contaminated", "documents"), "op4": ("doc_id", "documents"),
    "op5": ("doc_id piece start length ids_crc32 sequence_id offset", None),
    "op6": ("doc_id n_bytes n_removed n_spans kept_sha256", "documents"), "op7": ("doc_id held_out score predicted", "documents"),
    "op8": ("doc_id", "documents"), "op9": ("doc_id class_id class_size", "documents"),
    "op10": ("doc_id keep_id group_size kept text_sha256", "documents"), "op11": ("doc_id fingerprint component_id", "documents"),
    "op12": ("doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256", "documents"),
    "op13": ("anchor_id positive_id rank negative_id positive_score negative_score", None),
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_contract(spark, name):
    columns, table = CONTRACT[name.split("_")[0]]
    rows = QUERIES[name](spark, SF_DIR)
    assert set(columns.split()) <= set(rows.columns)
    if table:
        key = columns.split()[0]
        ids = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
        assert sorted(r[0] for r in rows.select(key).collect()) == sorted(r[0] for r in ids.collect())
    else:
        assert rows.count() > 0


def test_held_out_and_digest(spark):
    got = {r.doc_id: r.h for r in spark.range(50).withColumnRenamed("id", "doc_id").withColumn("h", held_out()).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}
    rows = spark.createDataFrame([(["10", "9", "2"],), ([],)], "items array<string>").select(items_digest().alias("d")).collect()
    assert [r.d for r in rows] == [hashlib.sha256(x).hexdigest() for x in (b"10,2,9", b"")]


def test_scores_do_not_use_the_held_out_labels(spark, tmp_path):
    """Turning the labels of held-out rows round changes no score."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = []
    for i, turned in enumerate((F.col("quality"), F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))):
        folder = str(tmp_path / str(i))
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.withColumn("quality", turned).write.parquet(f"{folder}/labels.parquet")
        got.append(sorted(tuple(r) for r in QUERIES["op7_pairwise_quality"](spark, folder).collect()))
    assert got[0] == got[1]
