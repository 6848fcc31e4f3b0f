"""Envelopes of discovery and entity feeds, and JSON maps of constants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _lenient_long(v: Column) -> Column:
    """A whole number given as a number or as text; anything else is null."""
    kind = F.schema_of_variant(v)
    return F.when(kind.isin("BIGINT", "STRING"), F.try_variant_get(v, "$", "string").try_cast("bigint"))


def parse_ref_envelope(df: DataFrame, json_col: str) -> DataFrame:
    """(contest_id, start_time) references of ``{"rows": [...]}`` texts.

    An id may be a number or a text. A row without ``match_id`` may hold a ``match_ids`` list,
    whose references have start time 0. Ids that are not positive whole numbers are dropped.
    """
    rows = df.select(F.explode(F.from_json(
        json_col, "rows array<struct<match_id:variant, start_time:variant, match_ids:array<variant>>>")["rows"]).alias("r"))
    one = F.array(F.struct(_lenient_long(F.col("r.match_id")).alias("contest_id"),
                           F.coalesce(_lenient_long(F.col("r.start_time")), F.lit(0).cast("bigint")).alias("start_time")))
    many = F.transform(F.coalesce("r.match_ids", F.array().cast("array<variant>")), lambda v: F.struct(
        _lenient_long(v).alias("contest_id"), F.lit(0).cast("bigint").alias("start_time")))
    refs = rows.select(F.inline(F.when(F.col("r.match_id").isNotNull(), one).otherwise(many)))
    return refs.filter(F.col("contest_id") > 0)


def parse_entity_envelope(df: DataFrame, json_col: str, fields: str, key: str) -> DataFrame:
    """Entities of ``{"rows": [...]}`` texts; rows that do not decode or have key 0 are dropped."""
    raw = df.select(F.explode(F.from_json(json_col, "rows array<string>")["rows"]).alias("_r"))
    return (raw.select(F.from_json("_r", fields).alias("e")).select("e.*")
            .filter(F.col(key).isNotNull() & (F.col(key) != 0)))


def parse_entity_array(df: DataFrame, json_col: str, fields: str) -> DataFrame:
    """Entities of texts holding one JSON list each."""
    inner = ", ".join(":".join(f.strip().split(" ", 1)) for f in fields.split(","))
    return df.select(F.inline(F.from_json(json_col, f"array<struct<{inner}>>")))


def parse_constants(df: DataFrame, json_col: str, value_type: str) -> DataFrame:
    """(key, value) rows of texts holding one JSON map each."""
    return df.select(F.explode(F.from_json(json_col, f"map<string, {value_type}>")).alias("key", "value"))


def read_constants(spark: SparkSession, path: str, value_type: str) -> DataFrame:
    """Constants files, one map per file."""
    return parse_constants(spark.read.text(path, wholetext=True), "value", value_type)


def read_entity_array(spark: SparkSession, path: str, fields: str) -> DataFrame:
    return spark.read.schema(fields).json(path, multiLine=True)


def unnest(df: DataFrame, **columns: str) -> DataFrame:
    """Parallel arrays of a row as rows: ``unnest(df, contest_id="ids", start_time="times")``."""
    zipped = F.arrays_zip(*[F.col(c).alias(name) for name, c in columns.items()])
    return df.select(F.inline(zipped)).toDF(*columns)
