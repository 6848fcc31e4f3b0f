"""Quality of transcripts by Bradley-Terry ranking: a document beats another with the logistic of its score's lead."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from draftlake.llm.texts import byte_chunks, scratch_table, word_hashes

# Labelled texts a block, bins a turn and rows that are few enough to be sorted in one place.
BLOCK = 256
BINS, FEW = 4096, 10_000

# Byte classes counted per text.
_CLASSES = {
    "upper": [(65, 91)], "lower": [(97, 123)], "digit": [(48, 58)], "space": [(32, 33)], "line": [(10, 11)],
    "stop": [(46, 47), (44, 45), (59, 60), (58, 59)], "shout": [(33, 34), (63, 64)], "wide": [(128, 192)],
    "mark": [(35, 44), (45, 46), (47, 48), (60, 63), (64, 65), (91, 97), (123, 127)], "control": [(0, 10), (11, 32), (127, 128)],
}
FEATURES = [*_CLASSES, "log_words", "word_length", "long_words", "distinct_words", "repeated_next", "distinct_pairs",
            "words_per_line", "top_word", "bytes_per_word"]


def text_features(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """One row of features per text: shares of byte classes, repetition and length of words and lines; null is empty."""
    out = np.zeros((batch.num_rows, len(FEATURES)))
    tables = [np.isin(np.arange(256), [b for lo, hi in spans for b in range(lo, hi)]) for spans in _CLASSES.values()]
    for at, end, data, offsets in byte_chunks(batch, column):
        hashes, bounds, starts, ends = word_hashes(data, offsets)
        length = ends - starts
        for i in range(at, end):
            text = data[offsets[i - at]:offsets[i - at + 1]]
            a, b = bounds[i - at], bounds[i - at + 1]
            counts = np.bincount(text, minlength=256) if len(text) else np.zeros(256)
            shares = [counts[t].sum() / max(1, len(text)) for t in tables]
            words, n = hashes[a:b], b - a
            kinds, times = np.unique(words, return_counts=True) if n else (words, np.zeros(1))
            pairs = len(np.unique(words[1:] ^ (words[:-1] << np.uint64(1)))) if n > 1 else 0
            out[i] = [*shares, np.log1p(n), length[a:b].mean() / 10 if n else 0, (length[a:b] > 20).mean() if n else 0,
                      len(kinds) / max(1, n) ** 0.8, (words[1:] == words[:-1]).mean() if n > 1 else 0,
                      pairs / max(1, n - 1), np.log1p(n / (1 + counts[10])), times.max() / max(1, n),
                      np.log1p(len(text) / max(1, n))]
    return out


@dataclass(frozen=True)
class RankModel:
    """Standardised weights and the score at the threshold quantile."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 at the threshold quantile."""
        lead = ((features - self.mean) / self.scale).clip(-8, 8) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-lead.clip(-700, 700)))


def labelled_blocks(transcripts: DataFrame, preferences: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(x, label) with the features of about ``BLOCK`` labelled texts a row; every labelled text is in one block.

    Blocks are dealt by a hash of the id. Features, not texts, meet the labels, so no text is shuffled. An id with several
    labels takes their rounded mean; a block takes at most twice its size, so repeated ids make more blocks.
    """
    one = preferences.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
    blocks = max(1, one.count() // BLOCK)
    kind = transcripts.schema[id_col].dataType.simpleString()

    def features(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(text_features(batch, "_text")), pa.list_(pa.float64()))], ["_id", "_x"])
    rows = transcripts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(features, f"_id {kind}, _x array<double>") \
        .join(one, "_id").select(F.pmod(F.xxhash64("_id"), F.lit(blocks)).alias("_block"), "_id", "_label", "_x") \
        .repartition("_block").sortWithinPartitions("_block", "_id", "_label", "_x").select("_block", "_label", "_x")

    def gather(batches):
        block, x, label = None, [], []

        def done():
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(x)], pa.list_(pa.float64())), pa.array([label], pa.list_(pa.int32()))], ["x", "label"])
        for batch in batches:
            for of, at, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if x and (of != block or len(x) >= 2 * BLOCK):
                    yield done()
                    x, label = [], []
                block = of
                x.append(row.values.to_numpy())
                label.append(at)
        if x:
            yield done()
    return scratch_table(rows.mapInArrow(gather, "x array<double>, label array<int>"), "quality")


def _unpacked(batches):
    for batch in batches:
        for x, label in zip(batch.column(0), batch.column(1)):
            yield x.values.to_numpy().reshape(-1, len(FEATURES)), label.values.to_numpy()


def _summed(blocks: DataFrame, part) -> np.ndarray | None:
    """Sum over all blocks of the vectors that ``part`` makes of one; a task sends one vector."""
    def fold(batches):
        total = None
        for x, label in _unpacked(batches):
            total = part(x, label) if total is None else total + part(x, label)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])
    rows = [np.array(r.total) for r in blocks.mapInArrow(fold, "total array<double>").collect()]
    return np.sum(rows, axis=0) if rows else None


def _pair_sums(x: np.ndarray, label: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Number of pairs, gradient and curvature of the logistic loss over all pairs of a preferred and another text of a block."""
    won, lost = x[label == 1], x[label == 0]
    p = 1 / (1 + np.exp(-((won @ weights)[:, None] - (lost @ weights)[None, :]).clip(-500, 500)))
    q = p * (1 - p)
    gradient = won.T @ (p - 1).sum(1) - lost.T @ (p - 1).sum(0)
    mixed = won.T @ q @ lost
    curve = (won.T * q.sum(1)) @ won + (lost.T * q.sum(0)) @ lost - mixed - mixed.T
    return np.concatenate([[p.size], gradient, curve.ravel()])


def _nth(scores: DataFrame, k: int) -> float:
    """The k-th smallest score (from 0), exactly: counts in ever narrower bins, then the values of a bin of few rows."""
    low, high, n = scores.agg(F.min("s"), F.max("s"), F.count("s")).first()
    below = 0
    for _ in range(8):
        width = (high - low) / BINS
        if n <= FEW or not width:
            break
        within = scores.where(F.col("s").between(low, high))
        at = F.least(F.floor((F.col("s") - low) / width), F.lit(BINS - 1))
        for _, n, first, last in sorted(within.groupBy(at.alias("b")).agg(F.count("s"), F.min("s"), F.max("s")).collect()):
            if below + n > k:
                low, high = first, last
                break
            below += n
    for value, n in sorted(scores.where(F.col("s").between(low, high)).groupBy("s").count().collect()):
        below += n
        if below > k:
            return value


def fit_blocks(blocks: DataFrame, penalty: float = 1e-3) -> RankModel:
    """Bradley-Terry weights by Newton steps on the logistic loss of feature differences (winner minus loser).

    The pairs are all of a preferred text and another one in a block, so every labelled text counts. The threshold is the
    quantile of all scores at the share of texts not preferred. Without both kinds of labels every score is 0.5 or above.
    """
    wide = len(FEATURES)
    sums = _summed(blocks, lambda x, label: np.concatenate([[len(x), (label == 1).sum()], x.sum(0)]))
    if sums is None:
        return RankModel(np.zeros(wide), np.ones(wide), np.zeros(wide), 0.0)
    n, preferred, mean = int(sums[0]), int(sums[1]), sums[2:] / sums[0]
    deviation = np.sqrt(_summed(blocks, lambda x, label: ((x - mean) ** 2).sum(0)) / n)
    scale, weights = np.where(deviation > 1e-9, deviation, 1.0), np.zeros(wide)
    if preferred in (0, n):
        return RankModel(mean, scale, weights, 0.0)

    def standard(x):
        return ((x - mean) / scale).clip(-8, 8)
    for _ in range(25):
        now = weights
        total = _summed(blocks, lambda x, label: _pair_sums(standard(x), label, now))
        pairs = max(1.0, total[0])
        gradient = total[1:wide + 1] / pairs + penalty * weights
        step = np.linalg.solve(total[wide + 1:].reshape(wide, wide) / pairs + penalty * np.eye(wide), gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break

    def score(batches):
        for x, _ in _unpacked(batches):
            yield pa.RecordBatch.from_arrays([pa.array(standard(x) @ weights, pa.float64())], ["s"])
    scores = blocks.mapInArrow(score, "s double")
    cut = n - preferred
    return RankModel(mean, scale, weights, (_nth(scores, cut - 1) + _nth(scores, cut)) / 2)


def fit_quality(transcripts: DataFrame, preferences: DataFrame, id_col: str = "contest_id", text_col: str = "transcript",
                label_col: str = "usable") -> RankModel:
    """Learn from all transcripts labelled usable or not (contest_id, usable)."""
    return fit_blocks(labelled_blocks(transcripts, preferences, id_col, text_col, label_col))


def score_quality(transcripts: DataFrame, model: RankModel, text_col: str = "transcript", score_col: str = "score") -> DataFrame:
    """Add ``score_col`` (0 to 1, higher: likelier usable) from the text alone; empty and null texts get a score too.

    Every column passes through; a column already named ``score_col`` is replaced.
    """
    source = transcripts.drop(score_col)
    shared = source.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            yield batch.append_column(score_col, pa.array(shared.value.score(text_features(batch, text_col)), pa.float64()))
    return source.mapInArrow(score, StructType([*source.schema.fields]).add(score_col, DoubleType()))


def usable_only(transcripts: DataFrame, model: RankModel, text_col: str = "transcript") -> DataFrame:
    """The transcripts that score 0.5 or more, with all their columns and nothing added."""
    shared = transcripts.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(text_features(batch, text_col)) >= 0.5))
    return transcripts.mapInArrow(keep, transcripts.schema)
