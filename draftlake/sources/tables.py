"""Table scans and writes."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftlake.functions.scalars import quarter_of

STAR_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One table of a directory; filters and columns reach the Parquet scan through Catalyst."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def read_frame(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_frame(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
              partitions: int, properties: dict | None = None) -> DataFrame:
    """A live relational table, read in parallel by ranges of a numeric key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def write_by_quarter(df: DataFrame, path: str, time_col: str = "start_time", mode: str = "overwrite",
                     key: str = "contest_id", files: int = 8, replace_all: bool = False) -> None:
    """Write a time table partitioned by UTC quarter, replacing only the quarters present in ``df``, or all of them.

    Rows are dealt by quarter and ``files`` parts of the key's hash before the write, so one busy quarter is spread
    over that many tasks while each task writes few files.
    """
    (df.withColumn("quarter", quarter_of(time_col))
       .repartition("quarter", F.pmod(F.xxhash64(key), F.lit(files)))
       .write.mode(mode)
       .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
       .partitionBy("quarter")
       .parquet(path))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact row count per table; Parquet answers each from its footers."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out



def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash by key into the session's number of shuffle partitions, before adaptive merging.

    For narrow rows that multiply right afterwards: their small size must not let adaptive
    execution merge them into a few tasks. Windows and aggregations on the keys reuse the exchange.
    """
    conf = df.sparkSession.conf
    n = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
            or conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def merge_contests(rows: DataFrame, contests: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows of contests (steps, players) to their contests on the contest id, after a shuffle of both.

    Both sides grow with the corpus. The optimizer's size of unfolded rows is that of the rows before, about one
    24th, so left to the size check it would send all steps through the driver. They are merged; a semi join asks for the
    ids alone, so those are hashed by partition and the many rows need no sort.
    """
    return rows.join(contests.hint("shuffle_hash" if how == "left_semi" else "merge"), "contest_id", how)
