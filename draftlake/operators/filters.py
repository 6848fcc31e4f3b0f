"""Row predicates and small filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import as_col, months_before, quarter_of

# Lobby codes.
COMPETITIVE_LOBBIES = (1, 2)
COMFORT_LOBBIES = (1, 2, 5, 6, 7)
DISCOVERY_LOBBIES = (1, 2, 6)


def is_competitive(league="league_id", lobby="lobby") -> Column:
    return (as_col(league) > 0) & as_col(lobby).isin(*COMPETITIVE_LOBBIES)


def competitive(contests: DataFrame) -> DataFrame:
    return contests.filter(is_competitive())


def has_both_teams(team0="team0", team1="team1") -> Column:
    """Both team ids present; an id of 0 counts as absent."""
    return F.coalesce((as_col(team0) != 0) & (as_col(team1) != 0), F.lit(False))


def both_teams(contests: DataFrame) -> DataFrame:
    return contests.filter(has_both_teams())


def comfort_eligible(players: DataFrame) -> DataFrame:
    return players.filter(
        F.col("lobby").isin(*COMFORT_LOBBIES)
        & F.col("account_id").isNotNull() & F.col("won").isNotNull() & (F.col("item_id") > 0))


def within_months(df: DataFrame, time_col: str, as_of: str | None, months: int = 6) -> DataFrame:
    """Rows not older than some calendar months before ``as_of``; ``None`` keeps all rows.

    On a table laid out by quarter the matching quarter predicate is added too, because the
    optimizer cannot derive it from the epoch column.
    """
    if as_of is None:
        return df
    edge = months_before(as_of, months)
    out = df.filter(F.col(time_col) >= edge)
    if "quarter" in df.columns:
        out = out.filter(F.col("quarter") >= quarter_of(edge))
    return out


def recent_contests(contests: DataFrame, as_of: str, days: int = 180, limit: int | None = None) -> DataFrame:
    """Discovery candidates of the last ``days``; with ``limit`` the newest of them, in order."""
    edge = F.unix_date(F.date_sub(F.lit(as_of).cast("date"), days)).cast("bigint") * 86400
    found = (contests.filter((F.col("start_time") >= edge) & F.col("lobby").isin(*DISCOVERY_LOBBIES))
             .select("contest_id", "start_time"))
    return found if limit is None else found.orderBy(F.desc("start_time"), F.desc("contest_id")).limit(limit)


def in_season(df: DataFrame, season: int | None) -> DataFrame:
    """Restrict to one season; 0 or None means the whole corpus."""
    return df.filter(F.col("season_id") == season) if season else df


def by_keys(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows whose key is in another frame, of any size."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def min_games(profile: DataFrame, games: int) -> DataFrame:
    return profile.filter(F.col("games") >= games)


def is_stub_name(name="name") -> Column:
    return as_col(name).startswith("unknown_")


# --- document validity --------------------------------------------------------------------

def valid_player_slot(slot) -> Column:
    slot = as_col(slot)
    return slot.between(0, 4) | slot.between(128, 132)


def rejection_reason() -> Column:
    """Why a decoded document is unusable, or null. Expects the nested document columns; an absent number is 0."""
    def some(array: str, test) -> Column:
        return F.coalesce(F.exists(F.col(array), test), F.lit(False))

    return (
        F.when(F.coalesce(F.col("match_id"), F.lit(0)) <= 0, "invalid_contest_id")
        .when(F.coalesce(F.col("start_time"), F.lit(0)) <= 0, "start_time_missing")
        .when(F.col("duration") < 0, "negative_duration")
        .when(some("players", lambda p: ~valid_player_slot(F.coalesce(p["player_slot"], F.lit(0)))),
              "invalid_player_slot")
        .when(some("players", lambda p: F.coalesce(p["hero_id"] < 0, F.lit(False))), "invalid_item_id")
        .when(some("picks_bans", lambda b: ~F.coalesce(b["team"], F.lit(0)).isin(0, 1)), "invalid_pick_side")
    )


def validate_contests(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoded documents into usable ones and rejected ones with their ``reason``."""
    checked = docs.withColumn("reason", rejection_reason())
    return checked.filter(F.col("reason").isNull()).drop("reason"), checked.filter(F.col("reason").isNotNull())


def is_parsed(players="players") -> Column:
    """True when any player carries a purchase log or a gold / experience curve."""
    return F.coalesce(
        F.exists(as_col(players), lambda p: F.coalesce(
            (p["purchase_log"].isNotNull() & (p["purchase_log"] != "null"))
            | (F.size(p["gold_t"]) > 0) | (F.size(p["xp_t"]) > 0), F.lit(False))),
        F.lit(False))
