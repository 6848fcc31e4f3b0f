"""Draft tables of a star-schema directory, in both variants."""

from __future__ import annotations

from pyspark.sql import SparkSession

from draftlake.operators.profiles import DraftTables
from draftlake.sources import star

AS_OF = star.AS_OF


def line_tables(spark: SparkSession, sf_dir: str) -> DraftTables:
    c = star.contests(spark, sf_dir)
    return DraftTables(c, star.line_steps(spark, sf_dir),
                       star.with_contest(star.line_players(spark, sf_dir), c), star.line_items(spark, sf_dir))


def seq_tables(spark: SparkSession, sf_dir: str) -> DraftTables:
    c = star.contests(spark, sf_dir)
    return DraftTables(c, star.sequence_steps(spark, sf_dir),
                       star.with_contest(star.sequence_players(spark, sf_dir), c), star.sequence_items(spark, sf_dir))
