"""Fingerprints, their links and groups, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from draftlake.llm import byte_index
from .conftest import edge_rows


def brute_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """The least place reachable over links of 3 bits or fewer, for each place."""
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return group


def low(i):
    return float("inf") if i is None else i


def test_every_five_places_hold_a_quadruple():
    assert len(byte_index.QUADS) == 14
    from itertools import combinations
    assert all(any(set(q) <= set(five) for q in byte_index.QUADS) for five in combinations(range(8), 5))


def test_fingerprints(monkeypatch):
    for piece, block in ((1 << 20, 1 << 17), (7, 2)):
        monkeypatch.setattr(byte_index, "PIECE", piece)
        monkeypatch.setattr(byte_index, "BLOCK", block)
        for _, text in edge_rows():
            for n in (1, 3, 5):
                assert byte_index.fingerprint((text or "").encode(), n) == brute_fingerprint(text, n)


@pytest.mark.parametrize("most", [64, 1])
def test_groups_of_transcripts(transcripts, nothing, most):
    rows = edge_rows()
    prints = [brute_fingerprint(t) for _, t in rows]
    group = brute_groups(prints)
    exp = Counter((c, f"{p:016x}", (lambda i: None if i == float("inf") else i)(min(low(rows[j][0]) for j in range(len(rows)) if group[j] == g)))
                  for (c, _), p, g in zip(rows, prints, group))
    got = byte_index.near_copies(transcripts, most=most)
    assert got.columns == ["contest_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == exp
    assert sum(n > 1 for n in Counter(group).values()) >= 2
    assert byte_index.near_copies(nothing).count() == 0


@pytest.mark.parametrize("most", [64, 3])
def test_links_of_crowds(spark, most):
    """Clouds around a few centres, chains of steps of 1, 2 and 3 bits, and pairs exactly 3 and 4 bits apart."""
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(60)}
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    for _ in range(3):
        centre = rng.getrandbits(64)
        prints |= {flip(centre, rng.randint(0, 5)) for _ in range(60)}
    chain = rng.getrandbits(64)
    for _ in range(60):
        prints.add(chain)
        chain = flip(chain, rng.choice([1, 2, 3, 4]))
    prints |= {0, (1 << 64) - 1, 7, 1 << 63}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = byte_index.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "_print long"), most).collect()
    place = {p: i for i, p in enumerate(signed)}
    group = list(range(len(prints)))
    for a, b in links:
        i, j = place[a], place[b]
        assert (prints[i] ^ prints[j]).bit_count() <= 3
        x, y = group[i], group[j]
        group = [min(x, y) if g in (x, y) else g for g in group]
    assert group == brute_groups(prints)
    assert max(np.bincount(group)) > 20 and len(set(group)) > 60
