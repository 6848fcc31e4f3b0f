"""Running state of a draft, per contest in slot order.

All windows share one partitioning (contest) and one sort (slot), so a plan that stacks them
shuffles once. A window partition is one draft: (contest, slot) is the key of the steps table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


OPEN_END = (1 << 63) - 1  # the newest season has no end


def _by_slot():
    return W.partitionBy("contest_id").orderBy("slot")


def _before():
    return _by_slot().rowsBetween(W.unboundedPreceding, -1)


def season_ranges(seasons: DataFrame) -> DataFrame:
    """First and last epoch second of every season; the newest one is open-ended.

    The boundary is taken over all seasons before any filter. Seasons are a small dimension, so
    the single window partition is harmless.
    """
    nxt = F.lead("release_at").over(W.orderBy("release_at"))
    return seasons.select(
        "season_id", F.col("release_at").alias("start_at"),
        F.coalesce(nxt - 1, F.lit(OPEN_END)).alias("end_at"))


def assign_phases(steps: DataFrame) -> DataFrame:
    """Phase number: how often the draft has switched between bans and picks so far."""
    switched = (F.col("is_pick") != F.lag("is_pick").over(_by_slot())).cast("int")
    return (steps.withColumn("_s", F.coalesce(switched, F.lit(0)))
            .withColumn("phase", F.sum("_s").over(_by_slot().rowsBetween(W.unboundedPreceding, W.currentRow)).cast("int"))
            .drop("_s"))


def derive_phases(steps: DataFrame) -> DataFrame:
    """Phase with its name and the side it belongs to; a draft opening with a pick starts at 1."""
    opens = F.first_value("is_pick").over(_by_slot())
    p = assign_phases(steps).withColumn("phase", F.col("phase") + opens.cast("int"))
    return (p.withColumn("phase_name", phase_name("phase", "is_pick"))
             .withColumn("phase_side", phase_side("phase", "is_pick")))


def phase_name(phase: str, is_pick: str) -> Column:
    kind = F.when(F.col(is_pick), "pick_").otherwise("ban_")
    return F.concat(kind, (F.floor(F.col(phase) / 2) + 1).cast("string"))


def phase_side(phase: str, is_pick: str) -> Column:
    """Bans of even phases and picks of odd phases belong to side 0."""
    return F.when((F.col(phase) % 2 == 1) == F.col(is_pick), 0).otherwise(1)


def local_slots(steps: DataFrame) -> DataFrame:
    """Position 0..n-1 inside the contest; declined bans leave gaps in the raw slot."""
    return steps.withColumn("local_slot", F.row_number().over(_by_slot()) - 1)


def _by_side(side0: Column, side1: Column, own: bool) -> Column:
    first, second = (side0, side1) if own else (side1, side0)
    return F.when(F.col("side") == 0, first).otherwise(second)


def draft_context(steps: DataFrame) -> DataFrame:
    """Picks and bans made before each slot, by the acting side, the other side and both."""
    def before(cond: Column) -> Column:
        return F.coalesce(F.sum(cond.cast("int")).over(_before()), F.lit(0)).cast("int")

    is_pick, side = F.col("is_pick"), F.col("side")
    counted = steps.select(
        "*",
        before(is_pick & (side == 0)).alias("_p0"), before(is_pick & (side == 1)).alias("_p1"),
        before(~is_pick & (side == 0)).alias("_b0"), before(~is_pick & (side == 1)).alias("_b1"))
    p0, p1, b0, b1 = (F.col(c) for c in ("_p0", "_p1", "_b0", "_b1"))
    return counted.select(
        *steps.columns,
        _by_side(p0, p1, True).alias("team_picks_before"), _by_side(p0, p1, False).alias("enemy_picks_before"),
        _by_side(b0, b1, True).alias("team_bans_before"), _by_side(b0, b1, False).alias("enemy_bans_before"),
        (p0 + p1).alias("picks_before"), (b0 + b1).alias("bans_before"))


def draft_state(steps: DataFrame) -> DataFrame:
    """Items drafted before each slot, and the earlier picks of the own and of the other side."""
    def before(cond: Column) -> Column:
        return F.collect_list(F.when(cond, F.col("item_id"))).over(_before())

    is_pick, side = F.col("is_pick"), F.col("side")
    gathered = steps.select(
        "*", before(F.lit(True)).alias("drafted"),
        before(is_pick & (side == 0)).alias("_p0"), before(is_pick & (side == 1)).alias("_p1"))
    p0, p1 = F.col("_p0"), F.col("_p1")
    return gathered.select(
        *steps.columns, "drafted",
        _by_side(p0, p1, True).alias("allies"), _by_side(p0, p1, False).alias("enemies"))


def rank_within(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """Rank 1..n inside a key; ``order`` must be a total order."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def rank_of_truth(scored: DataFrame, decision: list[str], score: str = "score", label: str = "label") -> DataFrame:
    """Rank of the item really chosen among the scored candidates, ties going to the lower item.

    Counts the candidates placed ahead of the true one. The window and the aggregation share
    one shuffle on the decision, whose candidates are at most the item catalogue.
    """
    truth = F.max(F.when(F.col(label) > 0, F.struct(F.col(score).alias("s"), F.col("item_id").alias("i"))))
    with_truth = scored.withColumn("_t", truth.over(W.partitionBy(*decision))).filter(F.col("_t").isNotNull())
    ahead = (F.col(score) > F.col("_t.s")) | ((F.col(score) == F.col("_t.s")) & (F.col("item_id") < F.col("_t.i")))
    return with_truth.groupBy(*decision).agg(
        F.max("_t.i").alias("true_item"), (F.count_if(ahead) + 1).alias("rank"))
