"""Quarter layout of the time tables: planning, health, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftlake.functions.scalars import quarter_of


def planned_quarters(spark: SparkSession, as_of: str, ahead: int, since: str | None = None) -> DataFrame:
    """Quarters from ``since`` (or the current one) to ``ahead`` quarters after the current one."""
    first = F.trunc(F.lit(since or as_of).cast("date"), "quarter")
    last = F.add_months(F.trunc(F.lit(as_of).cast("date"), "quarter"), 3 * ahead)
    days = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 3 months"))).alias("day"))
    return days.select(
        F.concat(F.year("day").cast("string"), F.lit("_q"), F.quarter("day").cast("string")).alias("quarter"),
        (F.unix_date("day").cast("bigint") * 86400).alias("start_at"),
        (F.unix_date(F.add_months("day", 3)).cast("bigint") * 86400).alias("end_at"))


def quarter_counts(table: DataFrame, time_col: str = "start_time") -> DataFrame:
    return table.groupBy(quarter_of(time_col).alias("quarter")).agg(F.count(F.lit(1)).alias("rows"))


def partition_health(tables: dict[str, DataFrame], quarters: DataFrame, threshold: int = 100,
                     time_col: str = "start_time") -> DataFrame:
    """Rows outside the planned quarters per table, above a threshold; else one ALL_OK row."""
    counts = None
    for name, df in tables.items():
        stray = quarter_counts(df, time_col).join(quarters.select("quarter"), "quarter", "left_anti")
        part = stray.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = part if counts is None else counts.unionByName(part)
    level = F.when(F.col("rows") > threshold * 10, "CRITICAL").otherwise("WARNING")
    bad = F.filter("all", lambda r: r["rows"] > threshold)
    # One entry per table; an empty list of findings becomes the single reassuring row.
    listed = counts.withColumn("level", level).agg(F.collect_list(F.struct("table_name", "rows", "level")).alias("all"))
    fine = F.array(F.struct(F.lit("ALL_OK").alias("table_name"), F.lit(0).cast("bigint").alias("rows"), F.lit("OK").alias("level")))
    return listed.select(F.inline(F.when(F.size(bad) > 0, bad).otherwise(fine)))


def expired_quarters(table: DataFrame, as_of: str, years: int = 2, time_col: str = "start_time") -> DataFrame:
    """Quarters whose year lies before the current year minus ``years``, with their rows."""
    year = F.substring("quarter", 1, 4).cast("int")
    return quarter_counts(table, time_col).filter(year < F.year(F.lit(as_of).cast("date")) - years)


def retain(table: DataFrame, as_of: str, years: int = 2, time_col: str = "start_time") -> DataFrame:
    """The table without its expired quarters."""
    year = F.substring(quarter_of(time_col), 1, 4).cast("int")
    return table.filter(year >= F.year(F.lit(as_of).cast("date")) - years)
