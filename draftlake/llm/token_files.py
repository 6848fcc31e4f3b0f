"""Token files: range asymmetric numeral coding of token ids with one shared frequency table.

A file set is two Parquet tables under one folder: ``table`` (token id, frequency out of 2**20) and ``blocks``. A block
holds the ids of consecutive transcripts and can be decoded on its own. Its payload is little-endian::

    4 bytes  magic "DLT1"
    uint32   tokens, lanes, steps between checkpoints, checkpoints, words, crc32 of the table, crc32 of the ids
    uint32   word position of each checkpoint
    uint64   lane states of each checkpoint (the first is the state to start from)
    uint32   words
    uint32   crc32 of everything before

Token i is coded in lane i mod lanes, all lanes a step at a time, so coding and decoding work on whole arrays; decoding
can start at any checkpoint.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from draftlake.llm.texts import scratch_table, shared_folder
from draftlake.llm.tokens import encoder

SCALE_BITS = 20
LOW = np.uint64(1 << 31)
BLOCK_TOKENS, LANES, CHECKPOINT_STEPS = 1 << 18, 1024, 64
_HEAD = struct.Struct("<4s7I")


class CorruptBlock(ValueError):
    """A block whose checksum, table or size does not fit."""


class FrequencyTable:
    """Frequencies out of 2**20 of the ids that occur, every one at least 1."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray):
        self.ids, self.frequencies = ids.astype(np.uint32), frequencies.astype(np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.frequencies)[:-1]]).astype(np.uint64) if len(ids) else self.frequencies
        self.crc = zlib.crc32(self.ids.tobytes() + self.frequencies.tobytes())
        self.symbol = np.full(int(self.ids.max()) + 1 if len(ids) else 1, -1, np.int64)
        self.symbol[self.ids] = np.arange(len(ids))
        self.slots = np.repeat(np.arange(len(ids), dtype=np.int32), self.frequencies.astype(np.int64))

    @classmethod
    def from_counts(cls, ids: np.ndarray, counts: np.ndarray) -> "FrequencyTable":
        """Scale counts to 2**20; the surplus or lack of rounding is settled among the most frequent ids."""
        scale = 1 << SCALE_BITS
        order = np.argsort(ids)
        ids, counts = ids[order], counts[order].astype(np.float64)
        if not len(ids):
            return cls(ids, counts)
        if len(ids) > scale:
            raise ValueError(f"{len(ids)} different ids do not fit a table of {scale}")
        f = np.maximum(1, np.floor(counts / counts.sum() * scale)).astype(np.int64)
        off = scale - int(f.sum())
        if off > 0:
            f[np.argmax(counts)] += off
        while off < 0:
            most = np.argsort(-f, kind="stable")
            for i in most:
                give = min(-off, int(f[i]) // 2)
                f[i] -= give
                off += give
                if not off:
                    break
        return cls(ids, f)


def encode_block(ids: np.ndarray, table: FrequencyTable, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
    """The payload of one block."""
    n = len(ids)
    lanes = max(1, min(lanes, n))
    symbols = table.symbol[ids]
    if n and symbols.min() < 0:
        raise ValueError("an id that the table does not hold")
    freq, start = table.frequencies[symbols], table.starts[symbols]
    x = np.full(lanes, LOW, np.uint64)
    bits, half = np.uint64(SCALE_BITS), np.uint64(32)
    steps, chunks, states, positions, written = -(-n // lanes), [], [], [], 0
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes:(t + 1) * lanes], start[t * lanes:(t + 1) * lanes]
        live = x[:len(f)]
        full = (live >> np.uint64(63 - SCALE_BITS)) >= f
        if full.any():
            out = live[full].astype(np.uint32)
            chunks.append(out)
            written += len(out)
            live[full] >>= half
        live[:] = ((live // f) << bits) + live % f + c
        if t % every == 0:
            states.append(x.copy())
            positions.append(written)
    if not steps:
        states, positions = [x], [0]
    words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.uint32)
    at = written - np.array(positions[::-1], np.int64)
    body = b"".join([_HEAD.pack(b"DLT1", n, lanes, every, len(at), written, table.crc, zlib.crc32(ids.astype("<u4").tobytes())),
                     at.astype("<u4").tobytes(), np.concatenate(states[::-1]).astype("<u8").tobytes(), words.astype("<u4").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(payload: bytes, table: FrequencyTable, checkpoint: int = 0, until: int | None = None) -> np.ndarray:
    """Ids from one checkpoint up to another (by default the whole block, whose checksum is then verified)."""
    if len(payload) < _HEAD.size + 4 or zlib.crc32(payload[:-4]) != struct.unpack("<I", payload[-4:])[0]:
        raise CorruptBlock("block checksum")
    magic, n, lanes, every, marks, n_words, table_crc, ids_crc = _HEAD.unpack_from(payload)
    if magic != b"DLT1" or table_crc != table.crc:
        raise CorruptBlock("not a block of this table")
    at = _HEAD.size
    positions = np.frombuffer(payload, "<u4", marks, at)
    states = np.frombuffer(payload, "<u8", marks * lanes, at + 4 * marks).reshape(marks, lanes)
    words = np.frombuffer(payload, "<u4", n_words, at + 4 * marks + 8 * marks * lanes).astype(np.uint64)
    until = marks if until is None else until
    first, last = checkpoint * every * lanes, min(n, until * every * lanes)
    x, read = states[checkpoint].copy(), int(positions[checkpoint])
    out = np.zeros(max(0, last - first), np.int32)
    mask, bits, half = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    for a in range(0, len(out), lanes):
        live = x[:len(out) - a]
        slot = live & mask
        s = table.slots[slot]
        out[a:a + lanes] = s
        live[:] = table.frequencies[s] * (live >> bits) + slot - table.starts[s]
        low = live < LOW
        k = int(np.count_nonzero(low))
        if k:
            live[low] = (live[low] << half) | words[read:read + k]
            read += k
    ids = table.ids[out] if len(out) else np.zeros(0, np.uint32)
    if not checkpoint and until == marks and zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise CorruptBlock("id checksum")
    return ids


def _raw_blocks(tokenizer: str, end_id: int, key: pa.DataType, block_tokens: int):
    """Blocks of ids; a task's last one also carries how often each id stands in all of the task's blocks."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("keys", pa.list_(key)), ("sizes", pa.list_(pa.int64())),
                        ("ids", pa.binary()), ("counted", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])

    def blocks(batches):
        part, block, encode = TaskContext.get().partitionId(), 0, encoder(tokenizer).encode_many
        keys, held, size, total = [], [], 0, np.zeros(0, np.int64)

        def done(last: bool):
            nonlocal total
            ids = np.concatenate(held)
            n = np.bincount(ids, minlength=len(total))
            n[:len(total)] += total
            total = n
            seen = np.flatnonzero(total) if last else total[:0]
            return pa.RecordBatch.from_pydict(
                {"part": [part], "block": [block], "keys": [keys], "sizes": [[len(x) for x in held]], "ids": [ids.astype("<u4").tobytes()],
                 "counted": pa.array([seen], pa.list_(pa.int64())), "counts": pa.array([total[seen]], pa.list_(pa.int64()))}, schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for k, ids in zip(rows.column(0).to_pylist(), encode([t or "" for t in rows.column(1).to_pylist()])):
                    if held and size + len(ids) >= block_tokens:
                        yield done(False)
                        block, keys, held, size = block + 1, [], [], 0
                    keys.append(k)
                    held.append(np.append(ids, end_id).astype(np.uint32))
                    size += len(ids) + 1
        if held:
            yield done(True)
    return blocks


def write_token_files(transcripts: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "contest_id",
                      text_col: str = "transcript", end_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> str:
    """Encode whole transcripts in ascending id order and write their token files; returns the folder.

    Every text is followed by ``end_id``; null counts as empty; repeated ids are all written, null ids first. A block
    ends before the transcript that would take it beyond ``block_tokens``; a longer transcript has a block of its own.
    The frequency table covers all ids of all transcripts; it is the only thing brought to the driver, and it has at
    most one row per id of the vocabulary. The text is shuffled once, by range of the id.
    """
    spark = transcripts.sparkSession
    path = path or f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    kind = transcripts.schema[id_col].dataType
    key = pa.string() if kind.typeName() == "string" else pa.int32() if kind.typeName() == "integer" else pa.int64()
    ordered = transcripts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .repartitionByRange("_id").sortWithinPartitions("_id", F.xxhash64("_text"))
    shape = f"part int, block int, keys array<{kind.simpleString()}>, sizes array<long>"
    raw = scratch_table(ordered.mapInArrow(_raw_blocks(tokenizer, end_id, key, block_tokens),
                                           f"{shape}, ids binary, counted array<long>, counts array<long>"), "raw-blocks")
    counts = raw.select(F.explode(F.arrays_zip("counted", "counts")).alias("c")) \
        .groupBy(F.col("c.counted").alias("id")).agg(F.sum("c.counts").alias("n")).toPandas()
    table = FrequencyTable.from_counts(counts["id"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.int64))
    spark.createDataFrame([(int(i), int(f)) for i, f in zip(table.ids, table.frequencies)], "id long, frequency long") \
        .coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(table)

    def coded(batches):
        for batch in batches:
            payload = [encode_block(np.frombuffer(x.as_buffer(), "<u4"), shared.value) for x in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(payload, pa.binary())],
                                             ["part", "block", "keys", "sizes", "payload"])
    raw.drop("counted", "counts").mapInArrow(coded, f"{shape}, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")
    return path


def read_token_files(spark: SparkSession, path: str, id_col: str = "contest_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every transcript of a folder of token files, decoded and verified.

    ``start`` counts the ids of all transcripts before it. A damaged block fails the read with CorruptBlock.
    """
    rows = spark.read.parquet(f"{path}/table").toPandas()
    table = spark.sparkContext.broadcast(FrequencyTable(rows.sort_values("id")["id"].to_numpy(), rows.sort_values("id")["frequency"].to_numpy()))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["keys"].dataType.elementType.simpleString()

    def decoded(batches):
        for batch in batches:
            part, block, keys, sizes, payloads = (batch.column(i) for i in range(5))
            for i in range(batch.num_rows):
                ids = decode_block(payloads[i].as_py(), table.value).astype("<u4")
                size = np.array(sizes[i].as_py(), np.int64)
                ends = np.cumsum(size)
                if len(ends) and ends[-1] != len(ids):
                    raise CorruptBlock("sizes")
                crc = [zlib.crc32(ids[b - n:b].tobytes()) for b, n in zip(ends, size)]
                n = len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[i].as_py()] * n, pa.int32()), pa.array([block[i].as_py()] * n, pa.int32()), keys[i].values,
                     pa.array(ends - size), pa.array(size), pa.array(crc, pa.int64())],
                    ["part", "block", "_id", "within", "n_tokens", "ids_crc32"])
    rows = blocks.mapInArrow(decoded, f"part int, block int, _id {kind}, within long, n_tokens long, ids_crc32 long")
    sums = blocks.select("part", "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    parts = sums.groupBy("part").agg(F.sum("n").alias("all"))
    parts = parts.select("part", F.coalesce(F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0)).alias("before_part"))
    offsets = sums.join(parts, "part").select("part", "block", (F.col("before_part") + F.coalesce(F.sum("n").over(
        Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("before"))
    return rows.join(offsets, ["part", "block"]).select(F.col("_id").alias(id_col), (F.col("before") + F.col("within")).alias("start"),
                                                       "n_tokens", "ids_crc32")
