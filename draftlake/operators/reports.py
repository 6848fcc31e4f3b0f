"""Coverage, row-count and data-quality reports: one aggregation pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import months_before
from draftlake.operators.filters import has_both_teams
from draftlake.sources.tables import table_counts


def coverage(contests: DataFrame, as_of: str) -> DataFrame:
    """Time span of the league contests and how many lie inside the horizon."""
    league = contests.filter(F.col("league_id") > 0)
    return league.agg(
        F.date_format(F.date_from_unix_date((F.min("start_time") / 86400).cast("int")), "yyyy-MM-dd").alias("earliest"),
        F.date_format(F.date_from_unix_date((F.max("start_time") / 86400).cast("int")), "yyyy-MM-dd").alias("latest"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("start_time") >= months_before(as_of, 6)).alias("within_horizon"))


def row_counts(contests: DataFrame, sides: DataFrame, steps: DataFrame, players: DataFrame, items: DataFrame,
               as_of: str) -> DataFrame:
    """Rows per table, and contest counts under each filter from a single pass."""
    league = F.col("league_id") > 0
    filtered = contests.agg(
        F.count_if(league).alias("a"), F.count_if(league & has_both_teams()).alias("b"),
        F.count_if(league & (F.col("start_time") >= months_before(as_of, 6))).alias("c"),
    ).select(F.inline(F.array(
        F.struct(F.lit("contests (league)").alias("table_name"), F.col("a").alias("row_count")),
        F.struct(F.lit("contests (both teams)").alias("table_name"), F.col("b").alias("row_count")),
        F.struct(F.lit("contests (horizon)").alias("table_name"), F.col("c").alias("row_count")))))
    return table_counts({"sides": sides, "steps": steps, "players": players, "items": items}).unionByName(filtered)


def quality_report(decisions: DataFrame, min_rows: int = 100, min_contests: int = 10) -> DataFrame:
    """Rows, distinct contests and items, nulls per column, and whether the frame is usable."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in decisions.columns]
    report = decisions.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("contest_id").alias("n_contests"),
        F.count_distinct("item_id").alias("n_items"), *nulls)
    return report.withColumn("usable", (F.col("n_rows") > min_rows) & (F.col("n_contests") > min_contests))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("stage", "kind").agg(F.count(F.lit(1)).alias("n"))
