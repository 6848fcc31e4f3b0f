"""Hard negatives by an inverted multi-index: cells of two half-vector codes, visited by their score bounds.

Each half of a vector has a codebook; a pair of codes is a cell. A cell's score with an anchor is at most the sum of its
two half scores, each that of the code plus the anchor half's length times the code's radius (the farthest member over all
rows). A heap runs through the cells of an anchor in order of these sums. It stops when no cell left can hold a row that
still counts: for positives when the bound is below the last one needed, for a window of negatives when it is below the
last one needed or the window itself. So results are exact, whatever the codebooks are like.

Anchors ask for cells in two turns: a first few, then whatever their thresholds leave open. In each turn, the rows of a
part of a cell meet the anchors that ask for it, a bounded number of both at a time.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from draftlake.llm.texts import one_row, pinned, scratch_table

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
SAMPLE, MOST_CODES, PER_CELL = 4096, 256, 256
SHELF, ANCHORS = 2048, 512
FIRST_CELLS = 4
NO_ID = LOWEST = -(1 << 63)
HIGHEST = (1 << 63) - 1
EXACT = 1 << 53


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of both halves, the radius of each code, and the number of shelves of each occupied cell."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    shelves: dict[int, int]
    width: int

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.books[0].shape[1]], x[:, self.books[0].shape[1]:]

    def codes(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(code of each half, distance to it) of each row."""
        codes, distances = [], []
        for half, book in zip(self.halves(x), self.books):
            near = ((book * book).sum(1) - 2 * half @ book.T).argmin(1)
            codes.append(near)
            distances.append(np.sqrt(((half - book[near]) ** 2).sum(1)))
        return codes, distances

    def half_bounds(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(upper, lower) bound of the half scores of one anchor with every code's members, a little beyond rounding."""
        upper, lower = [], []
        for half, book, radius in zip(self.halves(x[None]), self.books, self.radii):
            at, reach = (half @ book.T)[0], np.sqrt((half * half).sum()) * radius
            slack = 1e-6 + 1e-9 * (np.abs(half) @ np.abs(book).T + reach)[0]
            upper.append(at + reach + slack)
            lower.append(at - reach - slack)
        return upper, lower

    def visits(self, x: np.ndarray):
        """(upper bound, lower bound, cell) of every cell, highest upper bound first."""
        upper, lower = self.half_bounds(x)
        order = [np.argsort(-u, kind="stable") for u in upper]
        n = [len(o) for o in order]
        best = [u[o] for u, o in zip(upper, order)]
        heap = [(-(best[0][0] + best[1][0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            a, b = int(order[0][i]), int(order[1][j])
            yield -bound, lower[0][a] + lower[1][b], a * len(self.books[1]) + b
            if j + 1 < n[1]:
                heapq.heappush(heap, (-(best[0][i] + best[1][j + 1]), i, j + 1))
            if j == 0 and i + 1 < n[0]:
                heapq.heappush(heap, (-(best[0][i + 1] + best[1][0]), i + 1, 0))


def _codebook(x: np.ndarray, codes: int, turns: int = 12) -> np.ndarray:
    """Means of ``codes`` groups of the rows of a sample, by alternation from evenly spread rows."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    book = x[np.linspace(0, len(x) - 1, min(codes, len(x))).astype(int)].astype(float)
    for _ in range(turns):
        near = ((book * book).sum(1) - 2 * x @ book.T).argmin(1)
        count = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        book[count > 0] = sums[count > 0] / count[count > 0, None]
    return book


def _quantised(scale: float):
    """Rows with a whole vector, its components as floor(scale * x); others go."""
    def quantise(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("_x"))
            out = []
            for i in range(batch.num_rows):
                x = vectors[i].values
                ok = x is not None and not x.null_count
                x = np.floor(scale * x.to_numpy(zero_copy_only=False).astype(float)) if ok else None
                out.append(x.astype("<f8").tobytes() if ok and np.isfinite(x).all() else None)
            vec = pa.array(out, pa.binary())
            kept = vec.is_valid()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), vec], ["_row", "_id", "_label", "_anchor", "_vec"]).filter(kept)
    return quantise


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    parts = vectors.to_pylist()
    sizes = np.array([len(v) // 8 for v in parts], np.int64)
    flat = np.frombuffer(b"".join(parts), "<f8")
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole inner products; a product beyond 64 bits raises."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] >= EXACT:
        return np.array([[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a], np.int64).reshape(len(a), len(b))
    return np.rint(a @ b.T).astype(np.int64)


def _first(score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at`` (in id order) the k of highest score, ties in order."""
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= least]
    return at[np.argsort(-score[at], kind="stable")][:k]


def build_index(rows: DataFrame, width: int, count: int, codes: int | None) -> tuple[MultiIndex, DataFrame]:
    """The index and the rows with their cell and shelf.

    Codebooks are fitted on at most ``SAMPLE`` rows by a hash of the row; radii and cell sizes come from all rows. There are
    at most 256 codes a half, so that the directory of cells is bounded; a cell holds any number of shelves.
    """
    spark = rows.sparkSession
    codes = codes or int(np.clip(round((count / PER_CELL) ** 0.5), 1, MOST_CODES))
    sample = rows.orderBy(F.xxhash64("_row"), "_row").limit(SAMPLE).select("_vec").toPandas()["_vec"]
    x = _matrix(pa.array([bytes(v) for v in sample], pa.binary()), width)
    half = width // 2
    plain = MultiIndex((_codebook(x[:, :half], codes), _codebook(x[:, half:], codes)), (None, None), {}, width)
    shared = spark.sparkContext.broadcast(plain)

    def assign(batches):
        for batch in batches:
            index = shared.value
            (a, b), (near, far) = index.codes(_matrix(batch.column(4), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((a * len(index.books[1]) + b).astype(np.int32)), pa.array(near), pa.array(far)],
                                             [*batch.schema.names, "_cell", "_near", "_far"])
    kind = rows.schema.simpleString()[7:-1].replace(":", " ")
    celled = scratch_table(rows.mapInArrow(assign, f"{kind}, _cell int, _near double, _far double"), "cells")
    sizes = celled.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_near").alias("near"), F.max("_far").alias("far")).collect()
    radii = [np.zeros(len(b)) for b in plain.books]
    for r in sizes:
        for radius, code, distance in zip(radii, divmod(r["_cell"], len(plain.books[1])), (r["near"], r["far"])):
            radius[code] = max(radius[code], distance)
    shelves = {r["_cell"]: -(-r["n"] // SHELF) for r in sizes}
    directory = F.broadcast(spark.createDataFrame(list(shelves.items()), "_cell int, _shelves int"))  # at most 256 * 256 rows
    shelved = celled.join(directory, "_cell").withColumn("_shelf", F.pmod(F.xxhash64("_row"), F.col("_shelves")).cast("int")) \
        .drop("_near", "_far", "_shelves")
    return MultiIndex(plain.books, tuple(radii), shelves, width), shelved


def _requests(index, first_turn: bool):
    """(cell, shelf, anchor row, ...) of the cells an anchor asks for in this turn.

    ``_floor`` is the score below which no row counts any more, ``_top`` the score above which none does.
    """
    def ask(batches):
        for batch in batches:
            x = _matrix(batch.column(batch.schema.get_field_index("_vec")), index.value.width)
            floor, top = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_floor", "_top"))
            for i in range(batch.num_rows):
                cells, seen = [], 0
                for upper, lower, cell in index.value.visits(x[i]):
                    if upper < floor[i] or first_turn and seen == FIRST_CELLS:
                        break
                    if cell not in index.value.shelves or lower > top[i]:
                        continue
                    seen += 1
                    if first_turn or seen > FIRST_CELLS:
                        cells += [(cell, s) for s in range(index.value.shelves[cell])]
                if cells:
                    c, s = zip(*cells)
                    at = pa.array(np.full(len(c), i))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(s, pa.int32()), *(x.take(at) for x in batch.columns)],
                                                     ["_cell", "_shelf", *batch.schema.names])
    return ask


_FOUND = "_anchor_row long, _slot int, _score long, _id long, _row long"


def _met(index, pick):
    """Scores of a shelf's rows with the anchors that ask for it; ``pick`` gives the places an anchor keeps, by slot."""
    def meet(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by([("_id", "ascending"), ("_row", "ascending")])
            ids, numbers, labels = (rows[c].to_numpy() for c in ("_id", "_row", "_label"))
            scores = _scores(_matrix(anchors["_vec"].combine_chunks(), index.value.width), _matrix(rows["_vec"].combine_chunks(), index.value.width))
            for i, anchor in enumerate(anchors.drop_columns(["_vec"]).to_pylist()):
                for slot, at in pick(anchor, scores[i], labels, numbers):
                    out.append((np.full(len(at), anchor["_row"]), np.full(len(at), slot, np.int32), scores[i][at], ids[at], numbers[at]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int64, np.int64)]
        return pa.table([pa.array(c) for c in cols], ["_anchor_row", "_slot", "_score", "_id", "_row"])
    return meet


def _pick_positives(k: int):
    def pick(anchor, score, labels, numbers):
        at = np.flatnonzero((labels == anchor["_label"]) & (numbers != anchor["_row"]) & (score >= anchor["_floor"]))
        return [(0, _first(score, at, k))] if len(at) else []
    return pick


def _pick_negatives(k: int):
    def pick(anchor, score, labels, numbers):
        near = np.flatnonzero((labels != anchor["_label"]) & (score >= anchor["_floor"]) & (score <= anchor["_top"]))
        for w in anchor["_windows"] if len(near) else ():
            at = near[(score[near] >= w["floor"]) & (score[near] <= w["top"])]
            if len(at):
                yield w["slot"], _first(score, at, k)
    return pick


def _turn(anchors: DataFrame, shelved: DataFrame, index, pick, k: int, number: int, first_turn: bool) -> DataFrame:
    """The best k rows of each anchor and slot among the cells asked for in this turn.

    Anchors are dealt into ``number`` blocks of about 512, so a group is a block of anchors and a shelf of rows.
    """
    kind = anchors.schema.simpleString()[7:-1]
    asked = anchors.mapInArrow(_requests(index, first_turn), f"_cell:int,_shelf:int,{kind}")
    asked = scratch_table(asked.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(number)).cast("int")), "requests")
    wanted = asked.select("_cell", "_shelf", "_block").distinct().toDF("_cell", "_shelf", "_of")
    rows = shelved.select("_cell", "_shelf", "_row", "_id", "_label", "_vec").join(wanted, ["_cell", "_shelf"]).withColumnRenamed("_of", "_block")
    keys = ["_cell", "_shelf", "_block"]
    found = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(_met(index, pick), _FOUND)
    return scratch_table(_best(found, k).drop("_rank"), "met")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_anchor_row", "_slot").orderBy(F.desc("_score"), "_id", "_row")
    return found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)


def _floors(found: DataFrame, k: int) -> DataFrame:
    """The k-th best score found so far, where there are k."""
    return found.groupBy("_anchor_row", "_slot").agg(F.when(F.count("*") >= k, F.min("_score")).alias("_least"))


def mine_hard_negatives(vectors: DataFrame, id_col: str = "candidate_id", vector_col: str = "features", label_col: str = "label",
                        anchor_col: str = "is_anchor", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                        high: int = HIGH, scale: float = SCALE, codes: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for feature vectors of draft candidates.

    Takes one row per candidate: its id, its features (array of numbers), its label (a whole number) and whether it is an
    anchor. Components count as floor(scale * x), a score is the whole inner product with the anchor; higher scores come
    first, ties by smaller id, then by row. An anchor's positives are the first ``positives`` other rows of its label. For
    each, the first ``negatives`` rows of other labels whose score lies between ``low`` and ``high`` percent of the
    positive's score are returned, ranked from 1; all, if fewer.

    Rows with a null label, a null vector, or a null or non-finite component take no part. Shorter vectors count as
    filled up with zeros, a null anchor flag as no anchor, a null id as the smallest. Repeated rows count as rows, so an
    anchor row that occurs twice is answered twice. Extra columns are not read; no rows give no rows. A score beyond 64
    bits is an error.
    """
    spark = vectors.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    source = pinned(vectors.select(id_col, vector_col, label_col, anchor_col)).select(
        F.monotonically_increasing_id().alias("_row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.col(label_col).cast("long").alias("_label"), F.coalesce(F.col(anchor_col), F.lit(False)).alias("_anchor"),
        F.col(vector_col).cast("array<double>").alias("_x")).where("_label is not null and _x is not null")
    rows = scratch_table(source.mapInArrow(_quantised(scale), "_row long, _id long, _label long, _anchor boolean, _vec binary"), "vectors")
    count, bytes_, asking = one_row(rows, F.count("*"), F.max(F.octet_length("_vec")), F.count_if("_anchor"))
    if not asking:
        return spark.createDataFrame([], result)
    index, shelved = build_index(rows, bytes_ // 8, count, codes)
    shared, number = spark.sparkContext.broadcast(index), -(-asking // ANCHORS)
    anchors = scratch_table(shelved.where("_anchor").select("_row", "_id", "_label", "_vec"), "anchors")

    def search(asked: DataFrame, lift, pick, k: int) -> DataFrame:
        """Both turns: the first cells of every anchor, then all cells that its thresholds leave open."""
        found = _turn(asked, shelved, shared, pick, k, number, True)
        return _best(found.union(_turn(lift(asked, _floors(found, k)), shelved, shared, pick, k, number, False)), k)

    def lift_positives(asked, floors):
        floors = floors.select(F.col("_anchor_row").alias("_row"), "_least")
        return asked.join(floors, "_row", "left").withColumn("_floor", F.coalesce("_least", "_floor")).select(asked.columns)

    def lift_negatives(asked, floors):
        windows = asked.select("_row", F.explode("_windows").alias("_w")).select("_row", "_w.*")
        floors = floors.select(F.col("_anchor_row").alias("_row"), F.col("_slot").alias("slot"), "_least")
        return asked.drop("_windows", "_floor", "_top").join(
            _windows(windows.join(floors, ["_row", "slot"], "left").withColumn("floor", F.greatest("floor", "_least"))), "_row").select(asked.columns)

    asked = anchors.withColumn("_floor", F.lit(LOWEST)).withColumn("_top", F.lit(HIGHEST))
    own = scratch_table(search(asked, lift_positives, _pick_positives(positives), positives), "positives")
    bounds = own.where("_score >= 0").select(F.col("_anchor_row").alias("_row"), F.col("_rank").alias("slot"),
                                             F.expr(f"(_score * {low} + 99) div 100").alias("floor"), F.expr(f"(_score * {high}) div 100").alias("top"))
    bounds = bounds.where("floor <= top")  # below 0 a window holds nothing
    asked = scratch_table(anchors.join(_windows(bounds), "_row"), "windows")
    found = search(asked, lift_negatives, _pick_negatives(negatives), negatives)
    ids = anchors.select(F.col("_row").alias("_anchor_row"), F.col("_id").alias("_anchor_id"))
    known = own.select("_anchor_row", F.col("_rank").alias("_slot"), F.col("_id").alias("_positive"), F.col("_score").alias("positive_score")).join(ids, "_anchor_row")
    shown = [F.nullif(c, F.lit(NO_ID)) for c in ("_anchor_id", "_positive", "_id")]
    return found.join(known, ["_anchor_row", "_slot"]).select(
        shown[0].alias("anchor_id"), shown[1].alias("positive_id"), F.col("_rank").cast("int").alias("rank"), shown[2].alias("negative_id"),
        "positive_score", F.col("_score").alias("negative_score"))


def _windows(bounds: DataFrame) -> DataFrame:
    """Per anchor its windows (at most one per positive), the lowest score any of them needs and the highest."""
    return bounds.groupBy("_row").agg(F.min("floor").alias("_floor"), F.max("top").alias("_top"),
                                      F.sort_array(F.collect_list(F.struct("slot", "floor", "top"))).alias("_windows"))
