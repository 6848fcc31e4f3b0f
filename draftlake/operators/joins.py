"""Join shapes. Steps and players meet their contests by a merge; elsewhere measured sizes choose broadcast or shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import quarter_of
from draftlake.operators.windows import season_ranges
from draftlake.sources.tables import merge_contests


def left_fill(df: DataFrame, other: DataFrame, on: list[str], fills: dict[str, tuple[Column | None, object]]) -> DataFrame:
    """Left join; every named column falls back to another column and then to a constant."""
    out = df.join(other.select(*on, *fills), on, "left")
    for name, (fallback, default) in fills.items():
        options = [F.col(name)] + ([fallback] if fallback is not None else []) + [F.lit(default)]
        out = out.withColumn(name, F.coalesce(*options))
    return out


def needs_work(refs: DataFrame, contests: DataFrame) -> DataFrame:
    """References that are unknown, or known but not parsed yet."""
    known = contests.select("contest_id", F.col("is_parsed").alias("_parsed"))
    return refs.join(known, "contest_id", "left").filter(~F.coalesce("_parsed", F.lit(False))).drop("_parsed")


def known_refs(contests: DataFrame, refs: DataFrame) -> DataFrame:
    """Stored contests matching a reference by (contest_id, start_time)."""
    return contests.join(refs.select("contest_id", "start_time").distinct(), ["contest_id", "start_time"], "left_semi")


def missing_keys(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct non-zero keys of the facts that the dimension does not hold.

    The facts are reduced to distinct keys first, so a key making up a large share of the rows
    travels once per task.
    """
    keys = facts.select(F.col(fact_key).alias("key")).filter("key is not null and key <> 0").distinct()
    return keys.join(dim.select(F.col(dim_key).alias("key")), "key", "left_anti")


def season_at(df: DataFrame, time_col: str, seasons: DataFrame, how: str = "left") -> DataFrame:
    """Latest season released at or before each row's time (as-of join); the newest season is open-ended.

    Seasons are a small dimension: their releases travel as one sorted array, so the facts are neither shuffled nor
    joined. Of seasons released at the same time the largest id counts.
    """
    releases = seasons.filter("release_at is not null").agg(
        F.sort_array(F.collect_list(F.struct("release_at", "season_id"))).alias("v")).scalar()
    known = F.filter("_releases", lambda s: s["release_at"] <= F.col(time_col))
    out = df.withColumn("_releases", releases).withColumn("season_at_id", F.try_element_at(known, F.lit(-1))["season_id"]) \
        .drop("_releases")
    return out if how == "left" else out.filter(F.col("season_at_id").isNotNull())


def contests_of_season(contests: DataFrame, seasons: DataFrame, season: int) -> DataFrame:
    """Contests whose time lies in a season's window."""
    r = season_ranges(seasons).filter(F.col("season_id") == season)
    lo, hi = r.agg(F.max("start_at").alias("v")), r.agg(F.max("end_at").alias("v"))
    return contests.filter(F.col("start_time").between(lo.scalar(), hi.scalar()))


def rows_of_contests(rows: DataFrame, contests: DataFrame) -> DataFrame:
    """Rows of a time table stored by quarter that belong to some contests.

    The contests carry their start time, so their quarters are part of the join: when the rows are scanned, the
    quarters of a broadcast contest side prune the folders that are read.
    """
    keys = contests.select("contest_id", quarter_of("start_time").alias("quarter")).distinct()
    return rows.join(keys, ["contest_id", "quarter"])


def prior_selections(steps: DataFrame, same_side: bool) -> DataFrame:
    """Every pick with each earlier pick of the same or of the other side.

    A draft has ten picks at most, so the join on the contest stays within 45 rows per contest.
    """
    p = steps.filter(F.col("is_pick"))
    now = p.select("contest_id", "slot", "side", "item_id")
    earlier = p.select("contest_id", F.col("slot").alias("other_slot"), F.col("side").alias("other_side"),
                       F.col("item_id").alias("other_item"))
    side_test = F.col("side") == F.col("other_side") if same_side else F.col("side") != F.col("other_side")
    return now.join(earlier, "contest_id").filter((F.col("other_slot") < F.col("slot")) & side_test).drop("other_side")


def joinable_count(steps: DataFrame, contests: DataFrame, sides: DataFrame) -> DataFrame:
    """How many picks of league contests reach the team rows of their acting side."""
    c = contests.filter(F.col("league_id") > 0).select("contest_id", "team0", "team1")
    rows = merge_contests(steps.filter("is_pick"), c).withColumn(
        "team_id", F.when(F.col("side") == 0, F.col("team0")).otherwise(F.col("team1")))
    return rows.join(sides.select("contest_id", "team_id").hint("merge"), ["contest_id", "team_id"]).agg(
        F.count(F.lit(1)).alias("joinable_picks"))


def team_contests(contests: DataFrame) -> DataFrame:
    """Up to two team rows per contest; absent teams are left out, league 0 becomes null."""
    league = F.when(F.col("league_id") != 0, F.col("league_id"))
    rows = contests.select(
        "contest_id", "start_time", league.alias("league_id"),
        F.inline(F.array(
            F.struct(F.col("team0").alias("team_id"), F.lit(0).alias("side"), F.col("side0_won").alias("won")),
            F.struct(F.col("team1").alias("team_id"), F.lit(1).alias("side"), (~F.col("side0_won")).alias("won")))))
    return rows.filter(F.col("team_id").isNotNull() & (F.col("team_id") != 0))


# A key is hot when it holds more than one row in HOT_SHARE and more than HOT_ROWS rows; by the
# first rule there are fewer than HOT_SHARE hot keys, which bounds their broadcast.
HOT_SHARE, HOT_ROWS, SALTS = 1000, 2_000_000, 32


def salted_lookup(df: DataFrame, lookup: DataFrame, key: str, spread_by: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join to a frame with one row per ``key``, spreading the rows of hot keys.

    Adaptive skew handling needs a plain shuffle on both sides, which an aggregated lookup is not.
    Here hot keys are found by a count with a map-side combine; their rows get a salt from
    ``spread_by`` and their lookup row is repeated once per salt. Other keys are joined as usual.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).scalar()
    hot = F.broadcast(counts.filter((F.col("_n") > hot_rows) & (F.col("_n") * HOT_SHARE > total))
                      .select(key, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), F.lit(SALTS))).otherwise(0).cast("int")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = df.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    right = lookup.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"], "left").drop("_salt")
