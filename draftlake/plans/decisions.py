"""Draft decisions, their candidates, and the train / validation split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import (
    MIX_MODULUS, opponent_of, sample_base, sample_key, sample_mix, side_won, team_of,
)
from draftlake.operators.filters import in_season, is_competitive
from draftlake.operators.windows import draft_context, draft_state
from draftlake.sources.tables import merge_contests

# Sampled negatives per decision, seed and training share of the split.
NEGATIVES = 30
SPLIT_SEED = 42
TRAIN_PERCENT = 80

ID_SPAN = 32768  # item ids are two-byte integers


def decided_contests(contests: DataFrame) -> DataFrame:
    """Competitive contests with a known outcome: those that have decisions."""
    return contests.filter(is_competitive() & F.col("side0_won").isNotNull())


def decisions(steps: DataFrame, contests: DataFrame, season: int | None = None) -> DataFrame:
    """Every step of the competitive contests with a known outcome, seen from the acting side."""
    ok = in_season(decided_contests(contests), season)
    c = ok.select("contest_id", "start_time", "season_id", "side0_won", "team0", "team1")
    won = side_won("side", "side0_won")
    return merge_contests(steps, c).select(
        "contest_id", "start_time", "season_id", "slot", "is_pick", "item_id", "side",
        team_of("side").alias("acting_team"), opponent_of("side").alias("opp_team"),
        won.alias("acting_won"), won.cast("int").alias("value_label"))


def ordered_for_training(frame: DataFrame) -> DataFrame:
    """Contests kept together and in slot order inside each partition; no global sort."""
    return frame.repartition("contest_id").sortWithinPartitions("contest_id", "slot")


def decision_states(decided: DataFrame) -> DataFrame:
    """Decisions with everything known before the slot: drafted items, allies, enemies, counts."""
    return draft_state(draft_context(decided))


def catalogue_array(items: DataFrame) -> DataFrame:
    """The item ids as one sorted array. Ids are two-byte integers, so it has a fixed bound."""
    return items.filter((F.col("item_id") > 0) & (F.col("item_id") <= 32767)).agg(
        F.sort_array(F.collect_set("item_id")).alias("ids"))


def legal_pool(catalogue: Column, drafted) -> Column:
    """Items still free: the catalogue without the drafted ones."""
    return F.array_except(catalogue, F.col(drafted) if isinstance(drafted, str) else drafted)


def sampled_pool(pool: Column, n: int, seed: int) -> Column:
    """``n`` items of a pool in seeded order, chosen inside the row: no shuffle, no window.

    Key and item travel as one bigint, so the sort is over plain numbers. The one-element outer
    transform names the per-row part of the key, which is then computed once per row.
    """
    base = F.array(sample_base(seed, "contest_id", "slot"))
    packed = F.transform(base, lambda b: F.transform(pool, lambda i: sample_mix(b, i) * ID_SPAN + i))[0]
    return F.transform(F.slice(F.sort_array(packed), 1, n), lambda k: (k % ID_SPAN).cast("int"))


def candidate_arrays(states: DataFrame, items: DataFrame, n: int | None = NEGATIVES, seed: int = SPLIT_SEED) -> DataFrame:
    """Picks with their candidates as an array: the chosen item first, then other free items."""
    picks = states.filter(F.col("is_pick"))
    free = F.array_except("catalogue", F.array_append("drafted", F.col("item_id")))
    with_free = picks.withColumn("catalogue", catalogue_array(items).scalar()).withColumn("free", free)
    others = with_free["free"] if n is None else sampled_pool(with_free["free"], n, seed)
    return with_free.withColumn("others", others).drop("catalogue", "free")


def request_arrays(states: DataFrame, items: DataFrame) -> DataFrame:
    """Requested positions with the whole legal pool as candidates; nothing has been chosen yet."""
    pool = legal_pool(F.col("_catalogue"), "drafted")
    return states.withColumn("_catalogue", catalogue_array(items).scalar()).withColumn("pool", pool) \
        .withColumn("chosen", F.lit(False)).drop("_catalogue", "drafted")


def unusable_items(items: DataFrame) -> DataFrame:
    """Items that can be no candidate because their id is absent or no positive two-byte number, with the reason."""
    reason = F.when(F.col("item_id").isNull(), "absent").when(F.col("item_id") <= 0, "not positive").when(F.col("item_id") >= ID_SPAN, "beyond two bytes")
    return items.select("*", reason.alias("reason")).filter("reason is not null")


def candidates(states: DataFrame, items: DataFrame, n: int | None = NEGATIVES, seed: int = SPLIT_SEED) -> DataFrame:
    """One row per candidate of every pick; ``label`` is 1 for the item really chosen."""
    rows = candidate_arrays(states, items, n, seed)
    keep = [c for c in rows.columns if c not in ("item_id", "others", "drafted")]
    chosen = F.array(F.struct(F.col("item_id").alias("item_id"), F.lit(1.0).alias("label")))
    rest = F.transform("others", lambda i: F.struct(i.alias("item_id"), F.lit(0.0).alias("label")))
    return rows.select(*keep, F.inline(F.concat(chosen, rest)))


def is_training(contest="contest_id", seed: int = SPLIT_SEED) -> Column:
    """True for about four contests in five; a contest never falls on both sides."""
    return F.floor(sample_key(seed, contest, F.lit(0), F.lit(0)) * 100 / MIX_MODULUS) < TRAIN_PERCENT


def split_by_contest(frame: DataFrame, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    flagged = frame.withColumn("_train", is_training(seed=seed))
    return flagged.filter("_train").drop("_train"), flagged.filter("not _train").drop("_train")


def check_finite(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Bad values (null, NaN, infinite) per column, in one pass: a row per column."""
    def bad(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.count_if(v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))

    counted = frame.agg(*[bad(c).alias(c) for c in columns])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("bad_values")) for c in columns])))


def require_finite(frame: DataFrame, columns: list[str]) -> None:
    bad = [r["feature"] for r in check_finite(frame, columns).filter("bad_values > 0").collect()]
    if bad:
        raise ValueError(f"features with null or infinite values: {', '.join(sorted(bad))}")
