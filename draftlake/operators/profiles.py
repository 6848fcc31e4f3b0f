"""Shrunken win-rate profiles and other aggregates.

Each profile joins the steps or players to the eligible contests on the contest id, aggregates
with a map-side combine, and only then picks up names, so a popular team, actor or item costs
one partial row per task and no more.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import opponent_of, shrunk, side_won, team_of, won_flag
from draftlake.operators.filters import (
    comfort_eligible, has_both_teams, in_season, is_competitive, within_months,
)
from draftlake.sources.tables import merge_contests

# Pseudo-counts of the shrunken rates.
PRIOR_TEAM = 3
PRIOR_ACTOR = 5
PRIOR_ITEM = 10
HORIZON_MONTHS = 6


@dataclass(frozen=True)
class DraftTables:
    """The tables the profiles read. ``players`` rows carry time, lobby and outcome."""

    contests: DataFrame
    steps: DataFrame
    players: DataFrame
    items: DataFrame


def shrunk_rate(df: DataFrame, keys: list, won: Column, prior: float) -> DataFrame:
    """Games, wins and shrunken win rate per key; rows with an unknown outcome are left out."""
    return (df.withColumn("_won", won).filter(F.col("_won").isNotNull())
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("games"), F.sum(F.col("_won").cast("int")).alias("wins"))
            .withColumn("shrunk_wr", shrunk("wins", "games", prior)))


def eligible_contests(contests: DataFrame, as_of: str | None) -> DataFrame:
    """Competitive contests inside the horizon, with both teams and a known outcome."""
    ok = contests.filter(is_competitive() & has_both_teams() & F.col("side0_won").isNotNull())
    return within_months(ok, "start_time", as_of, HORIZON_MONTHS)


def picks(steps: DataFrame) -> DataFrame:
    return steps.filter(F.col("is_pick") & (F.col("item_id") > 0))


def eligible_picks(t: DraftTables, as_of: str | None) -> DataFrame:
    """Picks of the eligible contests with the acting team and the outcome of its side."""
    c = eligible_contests(t.contests, as_of).select("contest_id", "side0_won", "team0", "team1")
    return merge_contests(picks(t.steps), c).select(
        "contest_id", "side", "item_id", "side0_won",
        team_of("side").alias("team_id"), side_won("side", "side0_won").alias("won"))


def with_item_name(df: DataFrame, items: DataFrame, key: str = "item_id", name: str = "item_name") -> DataFrame:
    """Inner join to the catalogue, as an unknown item has no row in a profile."""
    return df.join(items.select(F.col("item_id").alias(key), F.col("item_name").alias(name)), key)


def team_item_profile(t: DraftTables, as_of: str | None) -> DataFrame:
    rates = shrunk_rate(eligible_picks(t, as_of), ["team_id", "item_id"], F.col("won"), PRIOR_TEAM)
    return with_item_name(rates, t.items)


def actor_item_profile(t: DraftTables, as_of: str | None) -> DataFrame:
    rows = within_months(comfort_eligible(t.players), "start_time", as_of, HORIZON_MONTHS)
    return with_item_name(
        shrunk_rate(rows, ["account_id", "item_id"], F.col("won"), PRIOR_ACTOR), t.items)


def actor_team_history(t: DraftTables, as_of: str | None) -> DataFrame:
    """Games, wins, last time and newest season of every actor with every team."""
    ok = within_months(t.contests.filter(is_competitive() & has_both_teams()), "start_time", as_of, HORIZON_MONTHS)
    c = ok.select("contest_id", "start_time", "season_id", "side0_won", "team0", "team1")
    rows = merge_contests(t.players.filter(F.col("account_id").isNotNull()).select("contest_id", "account_id", "side"), c)
    return rows.groupBy("account_id", team_of("side").alias("team_id")).agg(
        F.count(F.lit(1)).alias("games"),
        F.sum(F.coalesce(side_won("side", "side0_won").cast("int"), F.lit(0))).alias("wins"),
        F.max("start_time").alias("last_contest_time"),
        F.max("season_id").alias("last_season_id"))


def is_empty(view: DataFrame) -> Column:
    """True when a frame has no rows, found out when the plan runs."""
    return view.agg(F.count(F.lit(1)).alias("n")).scalar() == 0


def with_fallback(profile, t: DraftTables, as_of: str | None) -> DataFrame:
    """A profile over the horizon, or over all time when the horizon holds nothing.

    ``profile`` is one of the profile functions. The branch is chosen by a scalar in the plan, not by a job while
    planning. It stands at the contests and players: where the horizon holds something, the all-time branch finds no
    rows there, and adaptive execution drops what would follow.
    """
    view = profile(t, as_of)
    if as_of is None:
        return view
    none = is_empty(view)
    return view.unionByName(profile(replace(t, contests=t.contests.filter(none), players=t.players.filter(none)), None))


def item_global(t: DraftTables) -> DataFrame:
    """Picks and shrunken rate per item over all competitive contests."""
    c = t.contests.filter(is_competitive() & F.col("side0_won").isNotNull()).select("contest_id", "side0_won")
    rows = merge_contests(picks(t.steps), c)
    return (shrunk_rate(rows, ["item_id"], side_won("side", "side0_won"), PRIOR_TEAM)
            .select("item_id", F.col("games").alias("picks"), "wins", "shrunk_wr"))


def item_counts(t: DraftTables, items: DataFrame, season: int | None = None) -> DataFrame:
    """Pick and win counts for the given items; an item never picked has zeros."""
    c = in_season(t.contests.filter(is_competitive()), season).select("contest_id", "side0_won")
    counted = (merge_contests(picks(t.steps), c).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("picks"), F.sum(won_flag("side", "side0_won")).alias("wins")))
    return items.select("item_id").distinct().join(counted, "item_id", "left").select(
        "item_id",
        F.coalesce("picks", F.lit(0).cast("bigint")).alias("picks"),
        F.coalesce("wins", F.lit(0).cast("bigint")).alias("wins"))


def total_picks(t: DraftTables, season: int | None = None) -> DataFrame:
    c = in_season(t.contests.filter(is_competitive()), season).select("contest_id")
    return merge_contests(picks(t.steps), c).agg(F.count(F.lit(1)).alias("total_picks"))


def item_priors(decisions: DataFrame) -> DataFrame:
    """Pick rate, win rate and popularity of every picked item among the decisions."""
    chosen = decisions.filter(F.col("is_pick") & (F.col("item_id") > 0))
    total = chosen.agg(F.count(F.lit(1)).alias("n"))
    per_item = chosen.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("picks"), F.sum(F.col("acting_won").cast("int")).alias("wins"))
    return per_item.select(
        "item_id", "picks", "wins",
        ((F.col("picks") + 2.0) / (total.scalar() + 4.0)).alias("item_pick_rate"),
        shrunk("wins", "picks", PRIOR_ITEM).alias("item_wr"),
        F.log1p(F.col("picks").cast("double")).alias("item_popularity"))


def pick_frequency(t: DraftTables, season: int | None) -> DataFrame:
    """Share of all picks of a season that went to each item."""
    c = in_season(t.contests.filter(is_competitive()), season).select("contest_id")
    chosen = merge_contests(picks(t.steps), c)
    total = total_picks(t, season)
    return chosen.groupBy("item_id").agg(F.count(F.lit(1)).alias("picks")).select(
        "item_id", (F.col("picks") / total.scalar().cast("double")).alias("frequency"))


def signature(actor_item: DataFrame) -> DataFrame:
    """Best item of every actor by rate; more games, then the lower item id break a tie."""
    best = F.max(F.struct("shrunk_wr", "games", (-F.col("item_id")).alias("neg"))).alias("b")
    return actor_item.groupBy("account_id").agg(best).select(
        "account_id", (-F.col("b.neg")).alias("item_id"),
        F.col("b.shrunk_wr").alias("shrunk_wr"), F.col("b.games").alias("games"))


def head_to_head_all(contests: DataFrame) -> DataFrame:
    """Every unordered pair of opponents: games and wins of both, over known outcomes."""
    ok = contests.filter(has_both_teams() & F.col("side0_won").isNotNull() & (F.col("team0") != F.col("team1")))
    low_is_0 = F.col("team0") < F.col("team1")
    rows = ok.select(
        F.least("team0", "team1").alias("team_a"), F.greatest("team0", "team1").alias("team_b"),
        (F.col("side0_won") == low_is_0).cast("int").alias("a_won"))
    return rows.groupBy("team_a", "team_b").agg(
        F.count(F.lit(1)).alias("games"), F.sum("a_won").alias("a_wins"),
    ).withColumn("b_wins", F.col("games") - F.col("a_wins"))


def head_to_head(contests: DataFrame, a: int, b: int) -> DataFrame:
    lo, hi = min(a, b), max(a, b)
    row = head_to_head_all(
        contests.filter(F.col("team0").isin(a, b) & F.col("team1").isin(a, b))
    ).filter((F.col("team_a") == lo) & (F.col("team_b") == hi))
    wins = ("a_wins", "b_wins") if a == lo else ("b_wins", "a_wins")
    return row.select(F.lit(a).alias("team_a"), F.lit(b).alias("team_b"), "games",
                      F.col(wins[0]).alias("a_wins"), F.col(wins[1]).alias("b_wins"))


def opponents(sides: DataFrame, team_sides: DataFrame) -> DataFrame:
    """Side rows of contests in which the given rows' team also played (an EXISTS filter)."""
    return sides.join(team_sides.select("contest_id").distinct(), "contest_id", "left_semi")


def acting_teams(steps: DataFrame, contests: DataFrame) -> DataFrame:
    """Every step with the acting and the opposing team and the outcome for the acting side."""
    c = contests.select("contest_id", "start_time", "season_id", "side0_won", "team0", "team1")
    return merge_contests(steps, c).select(
        "contest_id", "start_time", "season_id", "slot", "is_pick", "item_id", "side",
        team_of("side").alias("acting_team"), opponent_of("side").alias("opp_team"),
        side_won("side", "side0_won").alias("acting_won"))


def rosters(players: DataFrame) -> DataFrame:
    """Actors of each side in seat order, unknown accounts dropped.

    Seats are unique per contest and limited to ten by the document rules, so the array is
    short; seats are reduced to one row each before they are gathered.
    """
    seats = players.groupBy("contest_id", "side", "player_slot").agg(F.min("account_id").alias("account_id"))
    return seats.groupBy("contest_id", "side").agg(
        F.sort_array(F.collect_list(F.when(F.col("account_id").isNotNull(), F.struct("player_slot", "account_id")))
                     ).alias("_s")
    ).select("contest_id", "side", F.transform("_s", lambda x: x["account_id"]).alias("accounts"))
