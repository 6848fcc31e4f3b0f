"""Exact duplicates by naming: equal fixed-size blocks share an integer, equal pairs of names share the next one."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.texts import one_row, pinned, scratch_table

BLOCK_BYTES = 4096


def _blocks_of(size: int, id_type: pa.DataType):
    schema = pa.schema([("_row", pa.int64()), ("_id", id_type), ("_sha", pa.string()), ("_n", pa.int32()),
                        ("_at", pa.int32()), ("_block", pa.binary())])

    def cut(batches):
        for batch in batches:
            rows = {f.name: [] for f in schema}
            held = 0
            for row, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                data = (text or "").encode("utf-8", "surrogatepass").lower()
                n = max(1, -(-len(data) // size))
                sha = hashlib.sha256(data).hexdigest()
                for at in range(n):
                    for name, v in zip(rows, (row, key, None if at else sha, n, at, data[at * size:(at + 1) * size])):
                        rows[name].append(v)
                held += len(data)
                if held > 1 << 23:
                    yield pa.RecordBatch.from_pydict(rows, schema)
                    rows, held = {f.name: [] for f in schema}, 0
            if rows["_row"]:
                yield pa.RecordBatch.from_pydict(rows, schema)
    return cut


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add _name: an integer that rows have in common exactly when they agree in all keys.

    A row's number is made of its row key and place. Keys that occur more than once take the smallest number of their
    rows; only those few keys are joined back, both sides by plain exchanges, so a hot key can be split.
    """
    numbered = df.withColumn("_number", F.expr("cast(cast(_row as decimal(20,0)) * 2147483648 + _at as decimal(38,0))"))
    repeated = numbered.groupBy(*keys).agg(F.min("_number").alias("_first"), F.count("*").alias("_times")).where("_times > 1")
    return numbered.join(scratch_table(repeated.drop("_times"), "repeated-keys"), keys, "left") \
        .withColumn("_name", F.coalesce("_first", "_number")).drop("_number", "_first")


def block_identities(transcripts: DataFrame, id_col: str = "contest_id", text_col: str = "transcript",
                     block_bytes: int = BLOCK_BYTES, row_col: str | None = None) -> DataFrame:
    """(_row, id, _sha, _n, _name) per transcript; (_n, _name) is equal exactly for equal texts (A-Z folded).

    Blocks of ``block_bytes`` UTF-8 bytes get integer names; then names are paired, neighbour with neighbour, and the
    pairs named, until each transcript has one name. Content is compared, never a hash. One shuffle of the text finds
    the distinct blocks, one brings the names back; later levels move integers only.
    """
    kind = transcripts.schema[id_col].dataType
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    if not row_col:
        transcripts = pinned(transcripts.select(id_col, text_col))
    source = transcripts.select(row.cast("long").alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    arrow_type = pa.string() if kind.typeName() == "string" else pa.int32() if kind.typeName() == "integer" else pa.int64()
    blocks = source.mapInArrow(_blocks_of(block_bytes, arrow_type),
                               f"_row long, _id {kind.simpleString()}, _sha string, _n int, _at int, _block binary")
    level = scratch_table(_named(blocks, ["_block"]).drop("_block"), "block-names")
    first = level.where("_at = 0").select("_row", "_id", "_sha", "_n", "_name")
    longest = one_row(level, F.max("_n"))[0] or 1
    if longest == 1:
        return first
    names = level.where("_n > 1").select("_row", "_at", "_name")
    while longest > 1:
        pairs = names.groupBy("_row", F.expr("_at div 2").cast("int").alias("_at")).agg(
            F.max(F.expr("if(_at % 2 = 0, _name, null)")).alias("_left"),
            F.coalesce(F.max(F.expr("if(_at % 2 = 1, _name, null)")), F.lit(-1).cast("decimal(38,0)")).alias("_right"))
        names = scratch_table(_named(pairs, ["_left", "_right"]).select("_row", "_at", "_name"), "pair-names")
        longest = -(-longest // 2)
    whole = first.where("_n > 1").drop("_name").join(names.select("_row", "_name"), "_row")
    return first.where("_n = 1").unionByName(whole)


def exact_copies(transcripts: DataFrame, id_col: str = "contest_id", text_col: str = "transcript",
                 block_bytes: int = BLOCK_BYTES, row_col: str | None = None) -> DataFrame:
    """Groups of equal transcripts: one row per transcript with keep_id, group_size, kept, text_sha256 and row_key.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and empty texts are equal. The row
    with the largest id stays; among repeated rows of that id, the one with the largest row key (``row_col``, or a
    number of the row). A null id is below every other. An empty table gives no rows; other columns are not read.
    """
    rows = block_identities(transcripts, id_col, text_col, block_bytes, row_col)
    groups = rows.groupBy("_n", "_name").agg(F.max(F.struct("_id", "_row")).alias("_keep"), F.count("*").alias("group_size")) \
        .where("group_size > 1")
    joined = rows.join(scratch_table(groups, "copy-groups"), ["_n", "_name"], "left") \
        .withColumn("_keep", F.coalesce("_keep", F.struct("_id", "_row")))
    return joined.select(
        F.col("_id").alias(id_col), F.col("_keep._id").alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("_row") == F.col("_keep._row")).alias("kept"), F.col("_sha").alias("text_sha256"),
        F.col("_row").alias("row_key"))
