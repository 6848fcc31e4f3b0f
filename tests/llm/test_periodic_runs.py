"""Periodic runs of words against brute force, and the number-theoretic transform against plain sums."""

import hashlib
import zlib

import numpy as np
import pytest

from draftlake.llm import periodic_runs
from draftlake.llm.queries import QUERIES
from .conftest import edge_rows


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            s, e = at, end + q
            if end > at and e - s >= max(6, 4 * q) and not any(words[s:e - r] == words[s + r:e] for r in range(1, q)):
                out.append((s, e - s, q))
            at = end + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize("prime", [periodic_runs.SMALL, periodic_runs.LARGE])
def test_transform(prime):
    rng = np.random.default_rng(0)
    for size in (2, 8, 64):
        a, b = rng.integers(0, prime[0], (2, 3, size))
        assert (periodic_runs.back_transform(periodic_runs.transform(a, prime), prime) == a).all()
        got = periodic_runs.back_transform(periodic_runs.transform(a, prime) * periodic_runs.transform(b, prime) % prime[0], prime)
        exp = [[sum(int(x[j]) * int(y[(i - j) % size]) for j in range(size)) % prime[0] for i in range(size)] for x, y in zip(a, b)]
        assert got.tolist() == exp


def test_blocks_without_mismatch(monkeypatch):
    ids = np.random.default_rng(1).integers(0, 2, 400)
    for small in (periodic_runs.SMALL, (65537, 3, 4)):
        monkeypatch.setattr(periodic_runs, "SMALL", small)
        for m in (1, 2, 4, 8):
            blocks = np.arange(0, 400 - m, m)
            got = periodic_runs.no_mismatch(ids, blocks, np.full(len(blocks), 400), m)
            exp = [[b + d + m <= 400 and (ids[b:b + m] == ids[b + d:b + d + m]).all() for d in range(m, 2 * m)] for b in blocks]
            assert got.tolist() == exp


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_texts(seed):
    rng = np.random.default_rng(seed)
    for _ in range(80):
        texts = []
        for _ in range(rng.integers(1, 5)):
            text = []
            for _ in range(rng.integers(0, 6)):
                text += rng.integers(0, rng.integers(2, 7), rng.integers(1, 24)).tolist() * int(rng.integers(1, 9))
                text = text[:max(0, len(text) - int(rng.integers(0, 3)))]
            texts.append(text)
        ids = np.array([i for t in texts for i in t], np.int64)
        found = [[] for _ in texts]
        for t, *run in periodic_runs.find_runs(ids, np.cumsum([0, *map(len, texts)])):
            found[t].append(tuple(run))
        for got, text in zip(found, texts):
            assert sorted(got, key=lambda r: (r[0], r[2])) == brute_runs(text)


def test_runs_of_long_texts():
    one = np.zeros(70_000, np.int64)
    assert periodic_runs.find_runs(one, np.array([0, len(one)])) == [(0, 0, 70_000, 1)]
    wide = np.tile(np.arange(40_000), 4)
    assert periodic_runs.find_runs(wide, np.array([0, len(wide)])) == [(0, 0, 160_000, 40_000)]
    assert periodic_runs.find_runs(wide[:-1], np.array([0, len(wide) - 1])) == []


def test_transcripts(transcripts, nothing):
    got = {}
    for r in periodic_runs.periodic_runs(transcripts).collect():
        got.setdefault(r.contest_id, []).append(([tuple(x) for x in r.runs], r.collapsed))
    for c, t in edge_rows():
        runs = brute_runs(split(t))
        assert (runs, brute_collapsed(split(t), runs)) in got[c]
    assert sum(map(len, got.values())) == len(edge_rows())
    assert got[62] == [([(0, 200, 1)], "ab")] and got[50] == [([], "")]
    assert periodic_runs.periodic_runs(nothing).count() == 0


def test_query(spark, tmp_path):
    rows = [(c, t) for c, t in edge_rows()] + [(1000 + i, " ".join(f"w{(i * j) % 17}" for j in range(i))) for i in range(0, 120, 3)]
    spark.createDataFrame([(*r, "runs", 1) for r in rows], "doc_id long, text string, runs string, _id int").write.parquet(str(tmp_path / "documents.parquet"))
    exp, planted = [], 0
    for c, t in rows:
        words = split(t)
        h = zlib.crc32(str(c).encode()) if c is not None else 1
        if h % 10 == 0 and words:
            planted += 1
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        runs = brute_runs(words)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{x},{y},{z}\n" for x, y, z in runs)
        exp.append((c, len(runs), s, n, q, 1000 * n // q if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
                    hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()))
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, exp))
    assert planted > 4 and sum(e[1] > 0 for e in exp) > 4
