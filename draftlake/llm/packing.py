"""Best-fit packing of token pieces into sequences: a configuration linear program over the length histogram."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from draftlake.llm.texts import scratch_table
from draftlake.llm.tokens import encoder

LENGTH = 2048
STEP, GAP = 0.125, 0.02


@dataclass(frozen=True)
class PackingPlan:
    """Where the r-th piece of each length goes: runs of equal sequences, at most a few per length.

    Run k of length l starts at rank first[l][k]; its sequences hold per[l][k] pieces of l each from place at[l][k], and
    are numbered from base[l][k].
    """

    first: dict[int, np.ndarray]
    per: dict[int, np.ndarray]
    at: dict[int, np.ndarray]
    base: dict[int, np.ndarray]
    sequences: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence number, offset) of pieces given by length and rank among the pieces of that length."""
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            of = np.flatnonzero(lengths == length)
            first, n = self.first[length], int(length)
            run = np.searchsorted(first, ranks[of], side="right") - 1
            within = ranks[of] - first[run]
            sequence[of] = self.base[n][run] + within // self.per[n][run]
            offset[of] = self.at[n][run] + within % self.per[n][run] * n
        return sequence, offset


def _fillings(worth: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most worth that fits each room, and the size it takes (-1: a gap)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    order = np.argsort(-sizes)
    sizes_d, worth_d = sizes[order], worth[order]
    begin = np.searchsorted(-sizes_d, -np.arange(capacity + 1))
    for c in range(int(sizes.min()), capacity + 1):
        k = begin[c]
        gain = worth_d[k:] + best[c - sizes_d[k:]]
        j = int(gain.argmax())
        if gain[j] > best[c - 1]:
            best[c], pick[c] = gain[j], order[k + j]
        else:
            best[c] = best[c - 1]
    return best, pick


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 120, rate: float = 0.05):
    """(fractional cover of the histogram by patterns, lower bound): the cover is a list of (pieces per size, sequences).

    Multiplicative weights: a length's worth starts at its size and falls with its cover. One knapsack a round prices the
    best pattern with each length; those within ``rate`` of the best of all are used, the least covered lengths first,
    until one of their lengths is covered by another eighth. No pattern has more pieces of a length than there are. The
    worths also give a lower bound on the sequences (the dual program). It ends when every length is covered and the
    cover is within GAP of that bound, or has not come nearer to it for ``rounds`` rounds.
    """
    load, used, total, bound, gap, since = np.zeros(len(sizes)), {}, 0.0, 0.0, np.inf, 0
    size, number = sizes.tolist(), counts.astype(float).tolist()
    while gap > GAP and since < rounds:
        worth = sizes * np.exp(-rate / STEP * (load - load.min())).clip(1e-12)
        best, pick = _fillings(worth, sizes, capacity)
        bound = max(bound, float((counts * worth).sum() / best[-1]))
        good = worth + best[capacity - sizes] >= (1 - rate) * best[-1]
        room, picks = [STEP] * len(size), pick.tolist()
        order = np.lexsort((-sizes, load))
        for i in order[good[order]].tolist():
            if room[i] < STEP:
                continue
            pattern, c = {i: 1}, capacity - size[i]
            while c > 0:
                j = picks[c]
                if j < 0 or pattern.get(j, 0) >= number[j]:
                    c -= 1
                    continue
                pattern[j] = pattern.get(j, 0) + 1
                c -= size[j]
            x = min(room[j] * number[j] / k for j, k in pattern.items())
            if x <= 0:
                continue
            for j, k in pattern.items():
                room[j] = max(room[j] - x * k / number[j], 0.0)
            key = tuple(sorted(pattern.items()))
            used[key] = used.get(key, 0.0) + x
            total += x
        load += STEP - np.array(room)
        if load.min() > 0:
            now = total / load.min() / bound - 1
            since = 0 if now < gap * 0.999 else since + 1
            gap = min(gap, now)
    return [(dict(k), x / load.min()) for k, x in used.items()], bound


def _best_fit(left: np.ndarray, sizes: np.ndarray, capacity: int):
    """Best-fit decreasing over a histogram: runs of equal sequences ({index: pieces}, number).

    Equal open sequences are kept together, so the work follows the number of different sequences, not of pieces.
    """
    open_runs: dict[int, list] = {}
    for i in np.argsort(-sizes):
        n, size = int(left[i]), int(sizes[i])
        while n:
            room = min((r for r in open_runs if r >= size), default=None)
            if room is None:
                per = min(capacity // size, n)
                runs = [[{int(i): per}, n // per]]
                n -= per * (n // per)
                open_runs.setdefault(capacity - per * size, []).extend(runs)
                continue
            content, many = open_runs[room].pop()
            if not open_runs[room]:
                del open_runs[room]
            per = min(room // size, n)
            take = min(many, n // per)
            if take < many:
                open_runs.setdefault(room, []).append([content, many - take])
            open_runs.setdefault(room - per * size, []).append([{**content, int(i): content.get(int(i), 0) + per}, take])
            n -= per * take
    return [(c, m) for runs in open_runs.values() for c, m in runs]


def plan_packing(histogram: dict[int, int], capacity: int = LENGTH, rounds: int = 120) -> PackingPlan:
    """Pack a histogram of piece lengths (1 to capacity) into few sequences.

    The program's fractional solution is rounded down pattern by pattern, and one more sequence of each pattern is used
    where its pieces are left, the largest fractions first, until these make up what rounding took. The rest, and the
    histogram as a whole, are packed best-fit decreasing, and the better of the two packings is used. All of it works on
    the histogram, which has at most ``capacity`` entries.
    """
    sizes = np.array(sorted(n for n, c in histogram.items() if c), np.int64)
    counts = np.array([histogram[int(n)] for n in sizes], np.int64)
    empty = PackingPlan({}, {}, {}, {}, 0)
    if not len(sizes):
        return empty
    left, runs = counts.copy(), []
    cover, _ = configurations(sizes, counts, capacity, rounds)
    more = round(sum(x - int(x) for _, x in cover))
    for part in (int, None):
        for pattern, x in sorted(cover, key=lambda p: -p[1] if part else int(p[1]) - p[1]):
            many = min([int(x) if part else min(1, more), *(int(left[i] // c) for i, c in pattern.items())])
            if many > 0:
                more -= 0 if part else many
                runs.append(({int(i): int(c) for i, c in pattern.items()}, many))
                for i, c in pattern.items():
                    left[i] -= c * many
    runs += _best_fit(left, sizes, capacity)
    plain = _best_fit(counts, sizes, capacity)
    if sum(m for _, m in plain) < sum(m for _, m in runs):
        runs = plain
    table: dict[int, list] = {int(n): [] for n in sizes}
    taken, base = {int(n): 0 for n in sizes}, 0
    for pattern, many in runs:
        at = 0
        for i, c in pattern.items():
            n = int(sizes[i])
            table[n].append((taken[n], c, at, base))
            taken[n] += c * many
            at += c * n
        base += many
    columns = [{n: np.array([r[k] for r in rows], np.int64) for n, rows in table.items()} for k in range(4)]
    return PackingPlan(*columns, base)


def token_pieces(transcripts: DataFrame, tokenizer: str, id_col: str = "contest_id", text_col: str = "transcript",
                 length: int = LENGTH, end_id: int = 0, digest: bool = False) -> DataFrame:
    """(id, piece, start, length, ids) of every transcript: its token ids and ``end_id``, cut only beyond ``length``.

    With ``digest`` the crc32 of the ids (ids_crc32) stands in place of the ids; they then never leave the task.
    """
    kind = transcripts.schema[id_col].dataType.simpleString()
    last, last_type = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())

    def cut(batches):
        encode = encoder(tokenizer).encode_many
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = encode([t or "" for t in part.column(1).to_pylist()])
                rows, piece, start, size, data = [], [], [], [], []
                for i, x in enumerate(ids):
                    x = np.append(x, end_id).astype("<u4")
                    for p, s in enumerate(range(0, len(x), length)):
                        rows.append(i)
                        piece.append(p)
                        start.append(s)
                        size.append(len(x[s:s + length]))
                        data.append(zlib.crc32(x[s:s + length]) if digest else x[s:s + length].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(data, last_type)], ["_id", "piece", "start", "length", last])
    return transcripts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")) \
        .mapInArrow(cut, f"_id {kind}, piece int, start long, length long, {last} {'long' if digest else 'binary'}").withColumnRenamed("_id", id_col)


def pack_transcripts(transcripts: DataFrame, tokenizer: str, id_col: str = "contest_id", text_col: str = "transcript",
                     length: int = LENGTH, end_id: int = 0, rounds: int = 120) -> DataFrame:
    """Pack whole transcripts into sequences of at most ``length`` tokens; one row per piece.

    Columns: id, piece (from 0), start (tokens of its transcript before it), length, ids_crc32 (of the little-endian
    unsigned 32-bit ids), sequence_id (from 0), offset (its place there, without gaps). Null text counts as empty and
    gives one piece with the end id alone; repeated rows are packed each; an empty table gives no rows.
    The pieces' lengths are written once with their crc; ranks within a length come from counts per (task, length), so
    no group of equal lengths meets in one task, and no text or ids are shuffled.
    """
    kind = transcripts.schema[id_col].dataType.simpleString()
    pieces = token_pieces(transcripts, tokenizer, id_col, text_col, length, end_id, digest=True) \
        .withColumnRenamed(id_col, "_id").withColumn("_task", F.spark_partition_id()).withColumn("_order", F.monotonically_increasing_id())
    pieces = scratch_table(pieces, "pieces")
    counts = pieces.groupBy("length", "_task").count()
    plan = plan_packing({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()},
                        length, rounds)
    shared = transcripts.sparkSession.sparkContext.broadcast(plan)
    before = counts.withColumn("_before", F.sum("count").over(
        Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = pieces.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_task").orderBy("_order")) - 1) \
        .join(before, ["length", "_task"]).select("_id", "piece", "start", "length", "ids_crc32",
                                                  (F.col("_rank") + F.coalesce("_before", F.lit(0))).alias("_rank"))

    def place(batches):
        for batch in batches:
            sequence, offset = shared.value.place(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             ["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return ranked.mapInArrow(place, f"_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long") \
        .withColumnRenamed("_id", id_col)
