"""Runs of words that repeat with a period: blocks located by convolution, their distances extended to whole runs.

A run of period q holds at least 4 q words. At the dyadic scale m <= q < 2 m it therefore covers two neighbouring
aligned blocks of m words that occur again q words later. For every block the squared differences to all places of the
window behind it are summed by a number-theoretic transform; where the sum is 0, the block has no mismatch. Distances at
which both neighbours have none are the seeds, and each is extended word by word to the whole stretch.

Sums are exact residues of a prime. A sum that is no 0 but has residue 0 costs one extension and is not a result, and no
block without mismatch can be missed. Blocks with a word that does not come back within the window are not transformed.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.texts import CHUNK_BYTES

LEAST, REPEATS = 6, 4
CELLS = 1 << 18
# Primes with roots of unity for every power of two up to a size, and a generator of each.
SMALL, LARGE = (65537, 3, 1 << 16), (2013265921, 31, 1 << 27)


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of products of residues; by shifts for the small prime, where 2**16 is -1."""
    if p != SMALL[0]:
        return x % p
    x = (x & 0xFFFF) - (x >> 16)
    return x + ((x >> 63) & p)


@lru_cache(maxsize=64)
def _twiddles(size: int, prime: tuple, inverse: bool) -> list[np.ndarray]:
    """Powers of the root of unity for each halving of ``size``, largest first."""
    p, generator, _ = prime
    root = pow(generator, (p - 1) // size, p)
    root = pow(root, -1, p) if inverse else root
    powers = np.ones(max(1, size // 2), np.int64)
    step = 1
    while step < len(powers):
        powers[step:2 * step] = powers[:step] * pow(root, step, p) % p
        step *= 2
    return [powers[::1 << k].copy() for k in range(size.bit_length() - 1)]


def transform(rows: np.ndarray, prime: tuple) -> np.ndarray:
    """Number-theoretic transform of each row (length a power of two), in bit-reversed order."""
    p, size = prime[0], rows.shape[1]
    for powers in _twiddles(size, prime, False):
        half = len(powers)
        pairs = rows.reshape(len(rows), -1, 2, half)
        out = np.empty_like(pairs)
        out[:, :, 0] = _mod(pairs[:, :, 0] + pairs[:, :, 1], p)
        out[:, :, 1] = _mod((pairs[:, :, 0] - pairs[:, :, 1] + p) * powers, p)
        rows = out.reshape(len(rows), size)
    return rows


def back_transform(rows: np.ndarray, prime: tuple) -> np.ndarray:
    """The rows that ``transform`` made these of."""
    p, size = prime[0], rows.shape[1]
    for powers in reversed(_twiddles(size, prime, True)):
        pairs = rows.reshape(len(rows), -1, 2, len(powers))
        high = _mod(pairs[:, :, 1] * powers, p)
        out = np.empty_like(pairs)
        out[:, :, 0] = _mod(pairs[:, :, 0] + high, p)
        out[:, :, 1] = _mod(pairs[:, :, 0] - high + p, p)
        rows = out.reshape(len(rows), size)
    return _mod(rows * pow(size, -1, p), p)


def no_mismatch(ids: np.ndarray, blocks: np.ndarray, ends: np.ndarray, m: int) -> np.ndarray:
    """For each block of m words at ``blocks``: whether it occurs again m, m + 1 ... 2 m - 1 words later, before ``ends``.

    The sum of squared differences is 0 modulo the prime; a wrong True is possible, a wrong False is not.
    """
    prime = SMALL if 2 * m <= SMALL[2] else LARGE
    p, size = prime[0], 2 * m
    values = ids % p
    out = np.zeros((len(blocks), m), bool)
    step = max(1, CELLS // size)
    for at in range(0, len(blocks), step):
        first = blocks[at:at + step, None]
        block = values[first + np.arange(m)]
        window = values[np.minimum(first + m + np.arange(size), len(values) - 1)]
        mirrored = np.zeros((len(block), size), np.int64)
        mirrored[:, 0] = block[:, 0]
        mirrored[:, m + 1:] = block[:, :0:-1]
        both = back_transform(_mod(transform(mirrored, prime) * transform(window, prime), p), prime)[:, :m]
        sums = np.cumsum(_mod(window * window, p), axis=1)
        squares = np.concatenate([sums[:, m - 1:m], sums[:, m:size - 1] - sums[:, :m - 1]], axis=1)
        squares += _mod(block * block, p).sum(1)[:, None]
        out[at:at + step] = ((squares - 2 * both) % p == 0) & (first + 2 * m + np.arange(m) <= ends[at:at + step, None])
    return out


def _return_distance(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How many words later each word comes again in its text; very far where it does not."""
    gap = np.full(len(ids), 1 << 40, np.int64)
    order = np.argsort(ids + text * (int(ids.max(initial=0)) + 1), kind="stable")
    same = (ids[order[1:]] == ids[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    gap[order[:-1][same]] = np.diff(order)[same]
    return gap


def _stretch(ids: np.ndarray, low: int, high: int, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` inside low..high in which words a period apart are equal, by growing steps both ways."""
    end, step = at, 32
    while end < high - period:
        stop = min(high - period, end + step)
        other = np.flatnonzero(ids[end:stop] != ids[end + period:stop + period])
        if len(other):
            end += int(other[0])
            break
        end, step = stop, 2 * step
    start, step = at, 32
    while start > low:
        stop = max(low, start - step)
        other = np.flatnonzero(ids[stop:start] != ids[stop + period:start + period])
        if len(other):
            start = stop + int(other[-1]) + 1
            break
        start, step = stop, 2 * step
    return start, end + period


def find_runs(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of every run of the texts ids[bounds[i]:bounds[i + 1]], starts from the text's first word.

    A run is as long as its smallest period allows, with at least 6 words and 4 periods.
    """
    sizes = np.diff(bounds)
    gap = _return_distance(ids, np.repeat(np.arange(len(sizes)), sizes))
    runs: list[tuple[int, int, int, int]] = []
    m = 1
    while (sizes >= max(LEAST, REPEATS * m)).any():
        texts = np.flatnonzero(sizes >= max(LEAST, REPEATS * m))
        number = sizes[texts] // m - 2
        of = np.repeat(texts, number)
        first = bounds[of] + m * (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number))
        far = np.concatenate([[0], np.cumsum(gap >= 2 * m)])
        usable = far[first + 2 * m] == far[first]
        of, first = of[usable], first[usable]
        if len(first):
            blocks, place = np.unique(np.concatenate([first, first + m]), return_inverse=True)
            ends = np.zeros(len(blocks), np.int64)
            ends[place] = np.concatenate([bounds[of + 1]] * 2)
            zero = no_mismatch(ids, blocks, ends, m)
            runs += _extended(ids, bounds, of, first, zero, place, m, runs)
        m *= 2
    return runs


def _extended(ids, bounds, of, first, zero, place, m, known) -> list[tuple[int, int, int, int]]:
    """Runs of periods m to 2 m - 1 from the distances at which two neighbouring blocks have no mismatch."""
    pair, distance = np.nonzero(zero[place[:len(first)]] & zero[place[len(first):]])
    begin, distance = first[pair], distance + m
    open_ = np.ones(len(begin), bool)
    for text, start, length, period in known:  # inside a run of a period that divides the distance: that run again
        if length >= 3 * m:
            start += bounds[text]
            a, b = np.searchsorted(begin, [start, start + length])
            open_[a:b] &= (begin[a:b] + 2 * m + distance[a:b] > start + length) | (distance[a:b] % period != 0)
    begin, distance, text = begin[open_], distance[open_], of[pair[open_]]
    order = np.lexsort((begin, distance, text))
    runs, last, reach = [], None, 0
    for t, d, b in zip(text[order].tolist(), distance[order].tolist(), begin[order].tolist()):
        if (t, d) == last and b < reach:
            continue
        start, end = _stretch(ids, int(bounds[t]), int(bounds[t + 1]), b, d)
        last, reach = (t, d), end - d
        if end - start >= max(LEAST, REPEATS * d):
            runs.append((t, start - int(bounds[t]), end - start, d))
    return runs


class _Ids(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains behind its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def _solve(texts: list[bytes]):
    numbers = _Ids()
    words = [t.split() for t in texts]
    bounds = np.cumsum([0, *map(len, words)])
    ids = np.fromiter((i for w in words for i in map(numbers.__getitem__, w)), np.int64, int(bounds[-1]))
    found = [[] for _ in texts]
    for text, start, length, period in find_runs(ids, bounds):
        found[text].append((start, length, period))
    for w, runs in zip(words, found):
        runs.sort(key=lambda r: (r[0], r[2]))
        yield [{"start": s, "length": n, "period": q} for s, n, q in runs], _collapsed(w, runs)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(transcripts: DataFrame, id_col: str = "contest_id", text_col: str = "transcript") -> DataFrame:
    """One row per transcript: its runs (start, length, period, in words from 0) and the collapsed text.

    Words are what white space (space, tab to carriage return) separates. A run is a stretch of at least 6 words and 4
    times its smallest period that no neighbouring word extends; runs come by start, then period. ``collapsed`` leaves out
    every word that a run contains behind its first period, and has one space between words. Null text counts as empty;
    texts without runs keep all words; repeated rows count as rows; extra columns are not read; no rows give no rows.
    Every row is worked through by itself, without a shuffle; a text of any length is transformed in bounded blocks.
    """
    kind = transcripts.schema[id_col].dataType.simpleString()

    def solve(batches):
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                end, held, texts = at, 0, []
                while end < batch.num_rows and (not texts or held < CHUNK_BYTES):
                    texts.append((batch.column(1)[end].as_py() or "").encode("utf-8", "surrogatepass"))
                    held += len(texts[-1])
                    end += 1
                runs, collapsed = zip(*_solve(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(runs, _RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["_id", "runs", "collapsed"])
                at = end
    return transcripts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        solve, f"_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string").withColumnRenamed("_id", id_col)


def longest_run(runs: str = "runs") -> F.Column:
    """The longest run of a row (then smallest start, then period); null without runs."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                            (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
