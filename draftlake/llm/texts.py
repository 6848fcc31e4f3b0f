"""Helpers for whole texts in Arrow batches: bounded chunks, word tables, hashes, shared scratch tables."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20

# A-Z folds to a-z; a word byte is a digit, a letter or any byte of a character beyond ASCII.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {}


def transcripts(chat: DataFrame) -> DataFrame:
    """One text per contest from its chat lines (contest_id, time, unit, key): messages in time order, one a line.

    Null messages are left out; a contest with none has an empty transcript.
    """
    line = F.struct(F.col("time"), F.col("unit"), F.col("key"))
    lines = F.array_sort(F.collect_list(F.when(F.col("key").isNotNull(), line)))
    return chat.groupBy("contest_id").agg(F.concat_ws("\n", F.transform(lines, lambda x: x["key"])).alias("transcript"))


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder the cluster names and read them back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """The same rows, in an order that every scan repeats, so that row numbers can be joined on.

    A plain scan of files has that; anything else (a shuffle's rows may come in any order) is written and read back.
    """
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() not in ("Project", "LogicalRelation"):
            return scratch_table(df, "rows")
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session that names none gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; on a cluster it has to name a shared folder")
        named = "file://" + tempfile.mkdtemp(prefix="draftlake-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def one_row(df: DataFrame, *columns: F.Column):
    """One row of aggregates over all rows, by way of a bounded number of partial rows."""
    return df.agg(*columns).first()


def byte_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """(first row, end row, bytes, offsets) of runs of rows holding about ``limit`` bytes; null counts as empty.

    A longer text is a run of its own; no text is cut.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at, n = 0, len(texts)
    while at < n:
        end = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1))
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64; kept per process up to the usual chunk."""
    if n <= 2 * CHUNK_BYTES:
        if not _powers:
            _powers["kept"] = _accumulate(2 * CHUNK_BYTES)
        return _powers["kept"]
    return _accumulate(n)


def _accumulate(n: int):
    out = []
    for base in (BASE, BASE_INVERSE):
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return tuple(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """P with hash of bytes[s:e] = (P[e] - P[s]) * inverse**s."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    _, down = powers(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_table(data: np.ndarray, offsets: np.ndarray):
    """(folded bytes, word starts, word ends, first word of each text and the end) of the words of a chunk."""
    folded = FOLD[data]
    mask = WORD[folded]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    filled = offsets[:-1] < offsets[1:]
    edge = offsets[:-1][filled]
    first[edge] = mask[edge]
    edge = offsets[1:][filled] - 1
    last[edge] = mask[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return folded, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(hashes, first word of each text and the end, starts, ends) of the lower-cased words of a chunk."""
    folded, starts, ends, bounds = word_table(data, offsets)
    return span_hashes(prefix_sums(folded), starts, ends), bounds, starts, ends


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive words of an array of word hashes (texts not told apart)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = (out ^ words[i:len(words) - n + 1 + i]) * BASE
    return mix(out)
