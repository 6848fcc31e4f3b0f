"""Hard negatives of feature vectors against a look through all pairs."""

import math
from collections import Counter

import numpy as np
import pytest

from draftlake.llm import hard_negatives
from draftlake.llm.queries import QUERIES

SCHEMA = "candidate_id long, features array<float>, label int, is_anchor boolean, _row string, _cell int"


def brute(rows, positives=5, negatives=10, double=False):
    """rows: (id, vector or None, label, anchor)."""
    usable = [(i, r[0], [math.floor(256 * (x if double else float(np.float32(x)))) for x in r[1]], r[2], r[3]) for i, r in enumerate(rows)
              if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    key = lambda s: (-s[0], float("-inf") if s[1] is None else s[1])
    out = Counter()
    for i, a, x, label, anchor in usable:
        if not anchor:
            continue
        scored = sorted(((sum(p * q for p, q in zip(x, y)), b, other == label) for j, b, y, other, _ in usable if j != i), key=key)
        for ps, p, _ in [s for s in scored if s[2]][:positives]:
            chosen = [s for s in scored if not s[2] and 30 * ps <= 100 * s[0] <= 90 * ps][:negatives]
            out.update((a, p, k, b, ps, s) for k, (s, b, _) in enumerate(chosen, 1))
    return out


def vectors(seed, n, dims=6, labels=3):
    """Clustered vectors with ties, repeated vectors and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, dims))
    rows = [(i, [round(float(x), 2) for x in centres[i % 5] + rng.normal(0, 0.4, dims)], int(rng.integers(0, labels)), i % 10 == 0) for i in range(n)]
    common = rows[3][1]
    rows += [(n + i, common, i % labels, i == 0) for i in range(40)]
    rows += [(5000, None, 1, True), (5001, rows[0][1], None, True), (5002, [None, *rows[0][1][1:]], 1, True), (5003, [float("nan")] * dims, 1, False),
             (5004, [float("inf")] * dims, 1, True), (5005, rows[1][1][:3], 1, True), (5006, rows[1][1], 2, None), (5007, [0.0] * dims, 0, True), (5008, [], 1, True)]
    return rows


@pytest.fixture(autouse=True)
def small_parts(monkeypatch):
    for name, value in (("SHELF", 16), ("ANCHORS", 8), ("FIRST_CELLS", 2)):
        monkeypatch.setattr(hard_negatives, name, value)


@pytest.mark.parametrize("codes", [None, 5])
def test_against_all_pairs(spark, codes):
    rows = vectors(1, 160)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = hard_negatives.mine_hard_negatives(frame, codes=codes)
    exp = brute(rows)
    assert Counter(map(tuple, got.collect())) == exp and len(exp) > 200


def test_repeated_rows_and_null_ids(spark):
    rows = vectors(2, 40) + [(0, [0.5] * 6, 1, True)] * 2 + [(None, [0.4] * 6, 1, True), (None, [0.41] * 6, 2, False)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert Counter(map(tuple, hard_negatives.mine_hard_negatives(frame, codes=3).collect())) == brute(rows)


def test_nothing_to_mine(spark):
    frame = spark.createDataFrame([], SCHEMA)
    got = hard_negatives.mine_hard_negatives(frame)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and got.count() == 0
    alone = spark.createDataFrame([(1, [1.0], 1, True, "x", 1), (2, [1.0], 1, False, "x", 1)], SCHEMA)
    assert hard_negatives.mine_hard_negatives(alone).count() == 0


def test_large_components_stay_exact():
    a = np.array([[2.0**40, 3.0]])
    assert hard_negatives._scores(a, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 3]]
    with pytest.raises(OverflowError):
        hard_negatives._scores(a, np.array([[2.0**40, 1.0]]))


def test_visits_run_through_all_cells_in_order():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 300, (400, 8)).round()
    books = tuple(hard_negatives._codebook(h, 6) for h in (x[:, :4], x[:, 4:]))
    index = hard_negatives.MultiIndex(books, (None, None), {}, 8)
    (a, b), distances = index.codes(x)
    radii = tuple(np.array([d[c == k].max(initial=0) for k in range(6)]) for c, d in zip((a, b), distances))
    index = hard_negatives.MultiIndex(books, radii, {}, 8)
    for anchor in x[:5]:
        visits = list(index.visits(anchor))
        assert sorted(c for *_, c in visits) == list(range(36)) and [v[0] for v in visits] == sorted((v[0] for v in visits), reverse=True)
        score, bound = x @ anchor, {c: (low, up) for up, low, c in visits}
        assert all(bound[int(c)][0] <= s <= bound[int(c)][1] for s, c in zip(score, a * 6 + b))


def test_features_of_draft_candidates(spark, monkeypatch):
    """The feature vectors that the library makes of draft candidates: chosen ones against those that were not chosen."""
    from pyspark.sql import functions as F

    from draftlake.plans.features import FEATURES
    from draftlake.registry.q_features import feature_frame
    for name, value in (("SHELF", 64), ("ANCHORS", 64)):
        monkeypatch.setattr(hard_negatives, name, value)
    frame = feature_frame(spark, "/root/testdata/sf0.001").orderBy("contest_id", "slot", "item_id").limit(300)
    frame = frame.select((F.col("contest_id") * 100_000 + F.col("slot") * 1000 + F.col("item_id")).alias("candidate_id"),
                         F.array(*FEATURES).alias("features"), F.col("label").cast("int").alias("label"), (F.col("label") == 1).alias("is_anchor"))
    rows = [tuple(r) for r in frame.collect()]
    table = spark.createDataFrame(rows, frame.schema)
    exp = brute(rows, double=True)
    assert Counter(map(tuple, hard_negatives.mine_hard_negatives(table).collect())) == exp and exp


def test_query(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 8)], int(rng.integers(0, 10))) for i in range(0, 1500, 5)]
    rows += [(7000, None, 1), (7100, rows[0][1], None), (7200, [None] * 8, 1)]
    spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, is_anchor int").write.parquet(str(tmp_path / "embeddings.parquet"))
    relabelled = [(i, x, (y + 1) % 10 if i % 7 == 0 and y is not None else y, i % 100 == 0) for i, x, y in rows]
    assert Counter(map(tuple, QUERIES["op13_hard_negatives"](spark, str(tmp_path)).collect())) == brute(relabelled)
