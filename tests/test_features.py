"""The feature registry: plans as small as the features asked for, own features, fallbacks chosen when the plan runs."""

import pytest
from pyspark.sql import functions as F
from test_scale_rules import tables

from draftlake.operators import joins, pairs, profiles
from draftlake.plans import decisions as dec
from draftlake.plans import features as feat
from draftlake.plans.feature_registry import DEFAULT, FeatureRegistry
from draftlake.sources.tables import write_by_quarter


@pytest.fixture(scope="module")
def inputs(spark):
    _, _, t = tables(spark, hot=0)
    decided = dec.decisions(t.steps, t.contests)
    ft = feat.FeatureTables(
        t.contests, t.players, t.items, profiles.team_item_profile(t, None), pairs.pair_synergy(t, None), pairs.pair_counter(t, None),
        profiles.actor_item_profile(t, None), profiles.item_global(t), profiles.item_priors(decided), decided.filter("is_pick").agg(F.count(F.lit(1)).alias("n")))
    return t, dec.decision_states(decided), ft


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_few_features_need_a_small_plan(inputs):
    _, states, ft = inputs
    whole = plan(feat.candidate_features(states, ft, 6))
    few = feat.candidate_features(states, ft, 6, features=["hero_wr", "attr_is_int", "is_first_pick", "team_picks_before", "draft_progress"])
    assert plan(few).count("Join") < whole.count("Join") / 3 and len(plan(few)) < len(whole) / 3
    assert few.columns[-5:] == ["hero_wr", "attr_is_int", "is_first_pick", "team_picks_before", "draft_progress"]


def test_every_feature_alone_is_what_it_is_among_all(inputs):
    _, states, ft = inputs
    keys = ["contest_id", "slot", "item_id"]
    whole = {tuple(r[k] for k in keys): r for r in feat.candidate_features(states, ft, 6).collect()}
    for names in (["team_picks"], ["mean_counter_vs_enemies"], ["player_comfort", "star_threat"], ["hero_meta_role_count", "hero_pick_rate"]):
        got = feat.candidate_features(states, ft, 6, features=names).collect()
        assert len(got) == len(whole)
        assert all(r[n] == whole[tuple(r[k] for k in keys)][n] for r in got for n in names)


def test_candidates_are_not_shuffled(spark, inputs):
    """No exchange stands above the rows unfolded from a decision."""
    _, states, ft = inputs

    def under(node, seen):
        """Whether candidates are unfolded in a plan's subtree; exchanges above them are added to ``seen``."""
        unfolded = any([under(node.children().apply(i), seen) for i in range(node.children().size())])
        if unfolded and "Exchange" in node.nodeName():
            seen.append(node.simpleString(200))
        return unfolded or node.nodeName() == "Generate" and "inline" in node.simpleString(1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows its exchanges
    try:
        physical = feat.candidate_features(states, ft, 6)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "inline" in physical.toString() and "Exchange" in physical.toString() and under(physical, seen := []) and seen == []


def test_contexts_are_dealt_row_by_row(spark, inputs):
    """Partner and roster rows go to their contests one by one, sorted by key, not gathered into lists before the shuffle."""
    _, states, ft = inputs

    def below_exchange(node, seen):
        children = [node.children().apply(i) for i in range(node.children().size())]
        if "Exchange" in node.nodeName() and "contest_id" in node.simpleString(300):
            seen += [c.simpleString(2000) for c in children]
        for c in children:
            below_exchange(c, seen)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows its exchanges
    try:
        physical = feat.candidate_features(states, ft, 6)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    below_exchange(physical, seen := [])
    assert seen and not [s for s in seen if "partial_collect_list" in s and ("partner" in s or "rates" in s)]


def test_own_features_and_errors(inputs):
    _, states, ft = inputs
    own = FeatureRegistry(DEFAULT)

    @own.feature()
    def twice_before(ft):
        return F.col("team_picks_before") * 2
    rows = feat.candidate_features(states, ft, 6, features=["twice_before", "team_picks_before"], registry=own).collect()
    assert rows and all(r["twice_before"] == 2 * r["team_picks_before"] for r in rows)
    with pytest.raises(ValueError):
        own.register("hero_wr", lambda ft: F.lit(1.0))
    with pytest.raises(KeyError):
        feat.candidate_features(states, ft, 6, features=["twice_before"])
    assert "twice_before" not in DEFAULT.features


def test_fallback_is_chosen_when_the_plan_runs(spark, inputs):
    t, _, _ = inputs
    every = {n: sorted(map(str, fn(t, None).collect())) for n, fn in (("a", profiles.team_item_profile), ("b", pairs.pair_counter))}
    spark.sparkContext.setJobGroup("planning", "planning")
    late = {n: profiles.with_fallback(fn, t, "2031-01-01") for n, fn in (("a", profiles.team_item_profile), ("b", pairs.pair_counter))}
    known = ~profiles.is_empty(profiles.actor_item_profile(t, None))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("running", "running")
    assert {n: sorted(map(str, f.collect())) for n, f in late.items()} == every
    assert spark.range(1).select(known.alias("k")).first()["k"]


def test_quarters_of_the_contests_prune_the_rows(spark, tmp_path):
    times = [946684800, 954547200, 962409600, 970358400]
    players = spark.createDataFrame([(c, times[c % 4], s) for c in range(40) for s in range(3)], "contest_id bigint, start_time bigint, player_slot int")
    write_by_quarter(players, str(tmp_path / "p"))
    spark.createDataFrame([(c, times[c % 4], c % 4) for c in range(40)], "contest_id bigint, start_time bigint, lobby int").write.parquet(str(tmp_path / "c"))
    asked = spark.read.parquet(str(tmp_path / "c")).filter("lobby = 2")
    found = joins.rows_of_contests(spark.read.parquet(str(tmp_path / "p")), asked)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted({r["contest_id"] for r in found.collect()}) == list(range(2, 40, 4)) and found.count() == 30


def test_unusable_items_are_reported(spark):
    items = spark.createDataFrame([(1,), (32767,), (32768,), (0,), (-4,), (None,)], "item_id bigint")
    assert sorted(map(str, (tuple(r) for r in dec.unusable_items(items).collect()))) == sorted(map(str, [
        (32768, "beyond two bytes"), (0, "not positive"), (-4, "not positive"), (None, "absent")]))
