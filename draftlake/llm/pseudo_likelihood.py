"""Masked pseudo-likelihood: a window network predicts every word from both sides; log-probabilities score a text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.texts import byte_chunks, word_hashes

FREQUENT, CLASSES, SIDE, WIDTH = 896, 32, 2, 16
TOKENS = CLASSES * CLASSES
PASSES, BATCH, RATE = 2, 8192, 0.08
SLICE = 4096


@dataclass(frozen=True)
class Vocabulary:
    """Word numbers: frequent words by rank, all others by hash into the rest of the 1024 tokens."""

    hashes: np.ndarray
    numbers: np.ndarray

    def tokens(self, words: np.ndarray) -> np.ndarray:
        rare = TOKENS - FREQUENT
        out = (FREQUENT + (words % np.uint64(rare))).astype(np.int64)
        if len(self.hashes) and len(words):
            at = np.searchsorted(self.hashes, words)
            at[at == len(self.hashes)] = 0
            same = self.hashes[at] == words
            out[same] = self.numbers[at[same]]
        return out


def vocabulary(source: DataFrame) -> Vocabulary:
    """The most frequent words over all texts of ``_text``; counts are summed per task, then by word."""
    def counted(batches):
        for batch in batches:
            for _, _, data, offsets in byte_chunks(batch, "_text"):
                words, n = np.unique(word_hashes(data, offsets)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])
    counts = source.select("_text").mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toPandas()
    words = top["word"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    return Vocabulary(words[order], order.astype(np.int64))


class WindowNetwork:
    """Word vectors of ``SIDE`` words on both sides, weighted by place, through tanh to a two-level softmax.

    p(word | sides) = p(class | h) p(word | class, h), each a softmax, so all 1024 probabilities sum to 1. The text's
    ends are an extra input token.
    """

    shapes = [(TOKENS + 1, WIDTH), (2 * SIDE, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,), (CLASSES, WIDTH, CLASSES),
              (CLASSES, CLASSES)]

    def __init__(self, flat: np.ndarray | None = None, seed: int = 11):
        sizes = [int(np.prod(s)) for s in self.shapes]
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = np.concatenate([rng.normal(0, d, n) for n, d in zip(sizes, (0.3, 0.0, 0.0, 0.1, 0.0, 0.1, 0.0))])
            flat[sizes[0]:sizes[0] + sizes[1]] = 1 / SIDE
        self.flat = flat.astype(np.float32)
        self.parts = [p.reshape(s) for p, s in zip(np.split(self.flat, np.cumsum(sizes)[:-1]), self.shapes)]

    @staticmethod
    def sides(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(2 SIDE, tokens) neighbours of every token within its own text."""
        n = len(tokens)
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        lo, hi = bounds[:-1][text], bounds[1:][text]
        at = np.arange(n)
        out = np.full((2 * SIDE, n), TOKENS, np.int16)
        for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
            ok = (at + d >= lo) & (at + d < hi)
            out[k, ok] = tokens[(at + d)[ok]]
        return out

    def _hidden(self, sides):
        vectors, place, bias = self.parts[:3]
        inputs = [vectors.take(s, 0) for s in sides]
        total = inputs[0] * place[0] + bias
        for x, w in zip(inputs[1:], place[1:]):
            total += x * w
        return inputs, np.tanh(total, out=total)

    @staticmethod
    def _softmax(scores):
        scores -= scores.max(1, keepdims=True)
        e = np.exp(scores)
        total = e.sum(1, keepdims=True)
        e /= total
        return e, scores, np.log(total)[:, 0]

    def log_probability(self, tokens: np.ndarray, sides: np.ndarray) -> np.ndarray:
        """log p of every token given its two sides."""
        out = np.zeros(len(tokens))
        for at in range(0, len(tokens), BATCH):
            t = tokens[at:at + BATCH]
            _, h = self._hidden(sides[:, at:at + BATCH])
            cls, within = t // CLASSES, t % CLASSES
            _, scores, norm = self._softmax(h @ self.parts[3] + self.parts[4])
            got = (scores[np.arange(len(t)), cls] - norm).astype(np.float64)
            order = np.argsort(cls.astype(np.int16), kind="stable")
            ends = np.searchsorted(cls[order], np.arange(CLASSES + 1))
            for c in np.flatnonzero(np.diff(ends)):
                of = order[ends[c]:ends[c + 1]]
                _, scores, norm = self._softmax(h[of] @ self.parts[5][c] + self.parts[6][c])
                got[of] += scores[np.arange(len(of)), within[of]] - norm
            out[at:at + BATCH] = got
        return out

    def learn(self, tokens: np.ndarray, sides: np.ndarray, squares: np.ndarray) -> None:
        """One pass of Adagrad steps over the tokens, BATCH at a time."""
        for at in range(0, len(tokens), BATCH):
            t, s = tokens[at:at + BATCH], sides[:, at:at + BATCH]
            n = len(t)
            inputs, h = self._hidden(s)
            cls, within = t // CLASSES, t % CLASSES
            p, _, _ = self._softmax(h @ self.parts[3] + self.parts[4])
            p[np.arange(n), cls] -= 1
            grads = [np.zeros(x, np.float32) for x in self.shapes]
            grads[3][:], grads[4][:] = h.T @ p, p.sum(0)
            back = p @ self.parts[3].T
            order = np.argsort(cls.astype(np.int16), kind="stable")
            ends = np.searchsorted(cls[order], np.arange(CLASSES + 1))
            for c in np.flatnonzero(np.diff(ends)):
                of = order[ends[c]:ends[c + 1]]
                q, _, _ = self._softmax(h[of] @ self.parts[5][c] + self.parts[6][c])
                q[np.arange(len(of)), within[of]] -= 1
                grads[5][c], grads[6][c] = h[of].T @ q, q.sum(0)
                back[of] += q @ self.parts[5][c].T
            back *= 1 - h * h
            for k, x in enumerate(inputs):
                grads[1][k] = (x * back).sum(0)
            grads[2][:] = back.sum(0)
            flat = s.ravel()
            by = np.argsort(flat, kind="stable")
            flat = flat[by]
            begin = np.flatnonzero(np.diff(flat, prepend=-1))
            kinds = flat[begin]
            share = np.concatenate([back * w for w in self.parts[1]])
            grads[0][kinds] = np.add.reduceat(share.take(by, 0), begin, axis=0)
            g = np.concatenate([x.ravel() for x in grads]) / np.float32(n)
            squares += g * g
            self.flat -= np.float32(RATE) * g / (np.sqrt(squares) + np.float32(1e-7))


def _token_chunks(batches, words: Vocabulary):
    for batch in batches:
        for at, end, data, offsets in byte_chunks(batch, "_text"):
            hashes, bounds, _, _ = word_hashes(data, offsets)
            yield batch, at, end, words.tokens(hashes), bounds


def train(source: DataFrame, words: Vocabulary, passes: int = PASSES) -> WindowNetwork:
    """Fit the network on every text of ``_text``: each pass takes its share of the texts, by hash.

    Within a pass every task trains on its own texts from the common weights; the weights are then averaged by number
    of tokens, slice by slice, in a shuffle. The network has a fixed size, so the driver and each broadcast hold that
    and no more, however many texts there are.
    """
    context = source.sparkSession.sparkContext
    network = WindowNetwork()
    for turn in range(passes):
        shared, vocab = context.broadcast(network.flat), context.broadcast(words)

        def fitted(batches, shared=shared, vocab=vocab):
            own, seen = WindowNetwork(shared.value.copy()), 0
            squares = np.full(len(own.flat), 1e-4, np.float32)
            for _, _, _, tokens, bounds in _token_chunks(batches, vocab.value):
                own.learn(tokens, WindowNetwork.sides(tokens, bounds), squares)
                seen += len(tokens)
            if seen:
                cuts = [own.flat[i:i + SLICE] for i in range(0, len(own.flat), SLICE)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(cuts)), pa.int32()), pa.array([seen] * len(cuts), pa.int64()),
                     pa.array([(c.astype(np.float64) * seen).tobytes() for c in cuts], pa.binary())], ["slice", "n", "sums"])

        def added(batches):
            total = {}
            for batch in batches:
                for k, n, sums in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    value = np.frombuffer(sums, np.float64)
                    before = total.get(k)
                    total[k] = (n, value) if before is None else (before[0] + n, before[1] + value)
            if total:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(total), pa.int32()), pa.array([v[0] for v in total.values()], pa.int64()),
                     pa.array([v[1].tobytes() for v in total.values()], pa.binary())], ["slice", "n", "sums"])
        schema = "slice int, n long, sums binary"
        part = source.where(F.pmod(F.xxhash64("_text"), F.lit(passes)) == turn).select("_text")
        rows = part.mapInArrow(fitted, schema).repartition("slice").mapInArrow(added, schema).collect()
        if rows:
            network = WindowNetwork(np.concatenate([np.frombuffer(r["sums"], np.float64) / r["n"] for r in sorted(rows, key=lambda r: r["slice"])]))
    return network


def pseudo_likelihood(transcripts: DataFrame, id_col: str = "contest_id", text_col: str = "transcript",
                      passes: int = PASSES) -> DataFrame:
    """(id, n_words, log_likelihood, perplexity) per transcript, from a network trained on all transcripts.

    log_likelihood is the sum over the words of log p(word | two words on either side); perplexity is
    exp(-log_likelihood / n_words). Words are lower-cased; the 896 most frequent have their own token, the others share
    128 by hash. A text without words (null, empty) has log_likelihood 0 and perplexity null. Repeated rows are scored
    each; no rows give no rows; other columns are not read.
    """
    source = transcripts.select(F.col(id_col).alias("_own"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    words = vocabulary(source)
    network = train(source, words, passes)
    context = transcripts.sparkSession.sparkContext
    shared, vocab = context.broadcast(network.flat), context.broadcast(words)
    kind = transcripts.schema[id_col].dataType.simpleString()

    def scored(batches):
        own = WindowNetwork(shared.value)
        for batch, at, end, tokens, bounds in _token_chunks(batches, vocab.value):
            sums = np.concatenate([[0.0], np.cumsum(own.log_probability(tokens, WindowNetwork.sides(tokens, bounds)))])
            n = np.diff(bounds)
            total = sums[bounds[1:]] - sums[bounds[:-1]]
            each = np.exp(np.minimum(700, -total / np.maximum(n, 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, end - at), pa.array(n.astype(np.int64)), pa.array(np.where(n > 0, total, 0.0)),
                 pa.array(each, mask=n == 0)], ["_own", "n_words", "log_likelihood", "perplexity"])
    return source.mapInArrow(scored, f"_own {kind}, n_words long, log_likelihood double, perplexity double").withColumnRenamed("_own", id_col)
