import math

import pytest
from pyspark.sql import functions as F

from draftlake.functions.scalars import attr_code, role_count, shrunk
from draftlake.plans import evaluation as ev
from draftlake.plans import scoring
from draftlake.plans.features import FEATURES


def test_linear_score(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, 0.0, 1.0), (3, 0.5, 0.5)], "item_id int, a double, b double")
    rows = scoring.linear_score(df, {"a": 0.3, "b": 0.7}, features=["a", "b"]).orderBy("item_id").collect()
    assert [r["score"] for r in rows] == pytest.approx([0.8, 1.2, 1.0])


def test_explanations(spark):
    df = spark.createDataFrame([(0.8, 0.5, 0.7, 0.0), (0.3, 0.5, 0.04 / 0.3, 0.0)],
                               "strong double, weak double, risky double, none double")
    w = {"strong": 0.3, "weak": 0.05, "risky": -0.3, "none": 1.0}
    a, b = scoring.explain(df, w, list(w)).collect()
    assert [r["factor"] for r in a["reasons"]] == ["strong"] and a["reasons"][0]["note"] == "contribution: 0.2400"
    assert [r["factor"] for r in a["risks"]] == ["risky"]
    assert b["reasons"] == [] and b["risks"] == []


def test_weights_cover_all_features():
    assert list(scoring.WEIGHTS) == FEATURES and len(FEATURES) == 24 and all(scoring.WEIGHTS.values())


def test_ensemble(spark):
    im = spark.createDataFrame([(1, 0.8), (2, 0.6)], "item_id int, score double")
    va = spark.createDataFrame([(1, 0.5), (2, 0.9)], "item_id int, score double")
    got = lambda v: [r["score"] for r in scoring.ensemble(im, v, ["item_id"]).orderBy("item_id").collect()]
    assert got(va) == pytest.approx([0.71, 0.69])
    assert got(va.filter("item_id = 1")) == pytest.approx([0.71, 0.6])
    assert got(None) == pytest.approx([0.8, 0.6])


def test_recall_and_ndcg(spark):
    df = spark.createDataFrame([(r,) for r in (-1, 0, 1, 2, 3, 4, 5, 10, 11, 20)], "rank int")
    rows = df.select("rank", ev.recall_at("rank", 1).alias("r1"), ev.recall_at("rank", 3).alias("r3"),
                     ev.recall_at("rank", 5).alias("r5"), ev.ndcg_at_10("rank").alias("n")).collect()
    for r in rows:
        k = r["rank"]
        assert (r["r1"], r["r3"], r["r5"]) == tuple(float(1 <= k <= n) for n in (1, 3, 5))
        assert r["n"] == pytest.approx(1 / math.log2(k + 1) if 1 <= k <= 10 else 0.0, abs=1e-12)


def test_overall_is_weighted(spark):
    schema = "total bigint, correct bigint, recall1 double, recall3 double, recall5 double, ndcg10 double"
    df = spark.createDataFrame([(20, 10, .5, .6, .7, .55), (30, 15, .3, .5, .8, .45)], schema)
    r = ev.combine_phases(df).first()
    assert (r["total"], r["correct"]) == (50, 25)
    assert [r[c] for c in ("recall1", "recall3", "recall5", "ndcg10")] == pytest.approx([.38, .54, .76, .49])
    empty = ev.combine_phases(df.limit(0)).first()
    assert [float(x) for x in empty] == [0.0] * 6


def test_rank_of_truth_ties(spark):
    from draftlake.operators.windows import rank_of_truth
    df = spark.createDataFrame([(1, 0, 5, .5, 1.0), (1, 0, 3, .5, 0.0), (1, 0, 9, .5, 0.0), (1, 0, 8, .9, 0.0)],
                               "contest_id int, slot int, item_id int, score double, label double")
    r = rank_of_truth(df, ["contest_id", "slot"]).first()
    assert (r["true_item"], r["rank"]) == (5, 3)


def test_attributes_and_rates(spark):
    df = spark.createDataFrame([("str", ["a", "b"]), ("agi", ["a"]), ("int", ["a", "b", "c"]), ("all", []), ("x", None)],
                               "attr string, roles array<string>")
    rows = df.select(attr_code("attr").alias("a"), role_count("roles").alias("n")).collect()
    assert [(r["a"], r["n"]) for r in rows] == [(1, 2), (2, 1), (3, 3), (4, 0), (0, 0)]
    r = spark.range(1).select(shrunk(F.lit(0), F.lit(0), 3).alias("a"), shrunk(F.lit(3), F.lit(4), 3).alias("b")).first()
    assert (r["a"], r["b"]) == (0.5, 0.6)


def test_draft_states_turn_to_the_acting_side(spark):
    req = spark.createDataFrame(
        [(1, 8, [1], [2], [3], [4], [10], [20], 100, 200), (2, 9, [1], [2], [3], [4], [10], [20], 100, 200)],
        "contest_id bigint, slot int, picks0 array<int>, picks1 array<int>, bans0 array<int>, bans1 array<int>, "
        "roster0 array<int>, roster1 array<int>, team0 bigint, team1 bigint")
    a, b = scoring.draft_states(req, spark).orderBy("contest_id").collect()
    assert (a["side"], a["acting_team"], a["allies"], a["enemies"], a["phase"]) == (0, 100, [1], [2], "pick_1")
    assert (b["side"], b["acting_team"], b["allies"], b["opp_roster"]) == (1, 200, [2], [10])
    assert sorted(a["drafted"]) == [1, 2, 3, 4]
