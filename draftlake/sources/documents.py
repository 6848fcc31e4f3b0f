"""Contest documents: one JSON object per contest, from files or any frame with a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftlake.schemas import document_schema


def read_match_docs(spark: SparkSession, path: str, one_per_line: bool = True, with_path: bool = False) -> DataFrame:
    """Raw documents in a column ``raw``, one per line or one per file, if wanted with the ``path`` of their file."""
    rows = spark.read.text(path, wholetext=not one_per_line)
    return rows.select(F.col("value").alias("raw"), *([F.col("_metadata.file_path").alias("path")] if with_path else []))


def stream_match_docs(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
            .withColumnRenamed("value", "raw"))


def parse_documents(df: DataFrame, raw: str = "raw", fields: list[str] | None = None) -> DataFrame:
    """The document's fields beside ``raw``; text that is no JSON object leaves them all null.

    ``fields`` names the top-level fields to read; the parser skips the rest. The parsed document is unfolded from an
    array of one, as filters on its fields would else be pushed below and parse the text (and build it) once more each.
    """
    schema = document_schema()
    if fields is not None:
        schema = T.StructType([f for f in schema.fields if f.name in fields])
    return df.select("*", F.inline(F.array(F.from_json(raw, schema))))
