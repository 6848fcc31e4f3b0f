"""Corpus pipeline over documents: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``. ORACLE_SQL is None: the learned classifier,
weighted sampling and the tokenizer are not expressible in SQL; tests hold each stage against brute force instead.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftlake.llm import block_names, decontaminate, packing, pairwise_quality, weighted_minhash
from draftlake.llm.queries import quality_labels, tokenizer_file
from draftlake.llm.texts import pinned, shared_folder

ORACLE_SQL = None
ROW = "_stage_row"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality model accepts."""
    model = pairwise_quality.fit_quality(docs, quality_labels(spark, sf_dir).withColumnRenamed("contest_id", "doc_id"),
                                         id_col="doc_id", text_col="text")
    return pairwise_quality.usable_only(docs, model, text_col="text")


def _without(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The numbered documents but those judged not kept (row_key, kept)."""
    gone = judged.where("not kept").select(F.col("row_key").alias(ROW))
    return docs.join(gone, ROW, "left_anti").drop(ROW)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    numbered = pinned(docs).withColumn(ROW, F.monotonically_increasing_id())
    return _without(numbered, block_names.exact_copies(numbered, id_col="doc_id", text_col="text", row_col=ROW)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    numbered = pinned(docs).withColumn(ROW, F.monotonically_increasing_id())
    return _without(numbered, weighted_minhash.near_copies(numbered, id_col="doc_id", text_col="text", row_col=ROW)).select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of benchmark windows; those hit over half of their words go. n_chars follows the text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_benchmark(docs, items, text_col="text", key_col="item_id", item_col="text",
                                           length_col="n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens."""
    return packing.pack_transcripts(docs, tokenizer_file(), id_col="doc_id", text_col="text", end_id=0)


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("benchmark_passages", benchmark_passages), ("packed", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents; each stage's rows are written to the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        rows = stage(spark, docs, sf_dir)
        rows.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    return docs
