"""Relational tables out of parsed contest documents.

Every function takes the frame of ``parse_documents`` and returns one table. Absent numbers stay
null, so that a later, fuller document can fill them; ``absent_as_zero`` gives the zero-filled
form on request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftlake.functions.scalars import json_or_null, known_id
from draftlake.operators.filters import is_parsed
from draftlake.schemas import OBJECTIVE_FIELDS, PLAYER_BLOBS, PLAYER_FIELDS

# Columns that are renamed on the way out of a document.
CONTEST_NAMES = {
    "match_id": "contest_id", "radiant_win": "side0_won", "lobby_type": "lobby", "patch": "season_id",
    "leagueid": "league_id", "radiant_team_id": "team0", "dire_team_id": "team1",
    "radiant_captain": "captain0", "dire_captain": "captain1", "radiant_score": "score0", "dire_score": "score1",
    "tower_status_radiant": "towers0", "tower_status_dire": "towers1",
    "barracks_status_radiant": "barracks0", "barracks_status_dire": "barracks1",
}
CONTEST_COLUMNS = [
    "match_id", "match_seq_num", "start_time", "duration", "radiant_win", "tower_status_radiant",
    "tower_status_dire", "barracks_status_radiant", "barracks_status_dire", "radiant_score", "dire_score",
    "first_blood_time", "lobby_type", "game_mode", "cluster", "region", "skill", "engine", "human_players",
    "version", "patch", "positive_votes", "negative_votes", "leagueid", "series_id", "series_type",
    "radiant_team_id", "dire_team_id", "radiant_captain", "dire_captain", "replay_salt", "replay_url",
]
PLAYER_NAMES = {
    "hero_id": "item_id", "patch": "season_id", "lobby_type": "lobby", "hero_variant": "item_variant",
    "throw": "throw_gold", "comeback": "comeback_gold", "loss": "loss_gold",
}
MAX_SMALL = 32767
_SPECIAL = {"player_slot", "account_id", "isRadiant", "win", "firstblood_claimed", "is_roaming"}


def _filled(df: DataFrame, keep_null: set[str]) -> DataFrame:
    """Numbers to 0 and texts to blank, except for the named columns."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if f.name in keep_null or kind.startswith(("array", "boolean")):
            out.append(F.col(f.name))
        else:
            blank = F.lit("") if kind == "string" else F.lit(0).cast(f.dataType)
            out.append(F.coalesce(F.col(f.name), blank).alias(f.name))
    return df.select(*out)


def decode_contests(docs: DataFrame, absent_as_zero: bool = False) -> DataFrame:
    """The contest root. An unknown outcome stays null in either form."""
    rows = docs.select(
        *[F.col(c).alias(CONTEST_NAMES.get(c, c)) for c in CONTEST_COLUMNS],
        json_or_null("pauses").alias("pauses"), is_parsed("players").alias("is_parsed"))
    if absent_as_zero:
        return _filled(rows, {"side0_won", "pauses"})
    return rows.withColumn("match_seq_num", known_id("match_seq_num")).withColumn(
        "replay_url", F.when(F.col("replay_url") != "", F.col("replay_url")))


def _children(docs: DataFrame, array: str, *keys: str) -> DataFrame:
    return docs.select(F.col("match_id").alias("contest_id"), *keys, F.explode(array).alias("c"))


def decode_players(docs: DataFrame, absent_as_zero: bool = False) -> DataFrame:
    """One row per player. ``won`` is null when the document does not tell; no side means side 1."""
    c = F.col("c")
    plain = [f.split()[0] for f in PLAYER_FIELDS.replace("\n", " ").split(",")]
    rows = _children(docs, "players", "start_time").select(
        "contest_id", c["player_slot"].alias("player_slot"), "start_time",
        known_id(c["account_id"]).alias("account_id"),
        F.when(F.coalesce(c["isRadiant"], F.lit(False)), 0).otherwise(1).alias("side"),
        (c["win"] == 1).alias("won"),
        F.coalesce(c["firstblood_claimed"] != 0, F.lit(False)).alias("firstblood_claimed"),
        F.coalesce(c["is_roaming"], F.lit(False)).alias("is_roaming"),
        *[c[f].alias(PLAYER_NAMES.get(f, f)) for f in plain if f not in _SPECIAL])
    if absent_as_zero:
        return _filled(rows, {"account_id"}).withColumn("won", F.coalesce("won", F.lit(False)))
    return rows


def decode_player_details(docs: DataFrame) -> DataFrame:
    """The JSON sub-documents of every player of a parsed document, as text."""
    c = F.col("c")
    return _children(docs.filter(is_parsed("players")), "players").select(
        "contest_id", c["player_slot"].alias("player_slot"),
        *[json_or_null(c[b]).alias(b) for b in PLAYER_BLOBS])


def decode_steps(docs: DataFrame) -> DataFrame:
    c = F.col("c")
    return _children(docs, "picks_bans").select(
        "contest_id", c["order"].alias("slot"), c["is_pick"].alias("is_pick"),
        c["hero_id"].alias("item_id"), c["team"].alias("side"))


def decode_draft_timings(docs: DataFrame) -> DataFrame:
    c = F.col("c")
    return _children(docs, "draft_timings").select(
        "contest_id", c["order"].alias("slot"), c["pick"].alias("is_pick"), c["active_team"].alias("active_side"),
        known_id(c["hero_id"]).alias("item_id"), c["player_slot"].alias("player_slot"),
        c["extra_time"].alias("extra_time"), c["total_time_taken"].alias("total_time_taken"))


def _objective_key(v: Column) -> Column:
    """A text or a whole number as text, anything else blank."""
    return F.coalesce(F.when(F.schema_of_variant(v).isin("STRING", "BIGINT"), F.try_variant_get(v, "$", "string")),
                      F.lit(""))


def decode_objectives(docs: DataFrame) -> DataFrame:
    """Objectives with their raw text; entries that are no objects are skipped."""
    raw = _children(docs, "objectives").filter(F.ltrim("c").startswith("{"))
    o = raw.select("*", F.explode(F.array(F.from_json("c", OBJECTIVE_FIELDS))).alias("o")).filter(F.col("o").isNotNull())
    zero = lambda n: F.coalesce(F.col(f"o.{n}"), F.lit(0)).alias(n)
    text = lambda n: F.coalesce(F.col(f"o.{n}"), F.lit("")).alias(n)
    return o.select("contest_id", zero("time"), text("type"), zero("slot"), zero("player_slot"), zero("team"),
                    _objective_key(F.col("o.key")).alias("key"), zero("value"), text("unit"), F.col("c").alias("raw"))


def decode_chat(docs: DataFrame) -> DataFrame:
    c = F.col("c")
    return _children(docs, "chat").select(
        "contest_id", c["time"].alias("time"), *[F.coalesce(c[n], F.lit("")).alias(n) for n in ("type", "unit", "key")],
        F.coalesce(c["player_slot"], F.lit(0)).alias("player_slot"))


def decode_teamfights(docs: DataFrame) -> DataFrame:
    c = F.col("c")
    return _children(docs, "teamfights").select(
        "contest_id", c["end"].alias("end_time"), F.coalesce(c["last_death"], F.lit(0)).alias("last_death"),
        F.coalesce(c["deaths"], F.lit(0)).alias("deaths"), json_or_null(c["players"]).alias("players"))


def decode_advantages(docs: DataFrame) -> DataFrame:
    """Both advantage curves of a contest; no row when both are empty."""
    some = (F.coalesce(F.size("radiant_gold_adv"), F.lit(0)) > 0) | (F.coalesce(F.size("radiant_xp_adv"), F.lit(0)) > 0)
    return docs.filter(some).select(
        F.col("match_id").alias("contest_id"), F.col("radiant_gold_adv").alias("gold_adv"),
        F.col("radiant_xp_adv").alias("xp_adv"))


def decode_cosmetics(docs: DataFrame) -> DataFrame:
    blob = json_or_null("cosmetics")
    return docs.select(F.col("match_id").alias("contest_id"), blob.alias("cosmetics")).filter("cosmetics is not null")


def expand_timeseries(players: DataFrame) -> DataFrame:
    """One row per player and minute, up to the longest of the player's curves.

    A minute present in none of the four curves is left out; a curve that is too short counts 0;
    last hits and denies are capped at the two-byte range of the column. ``zip`` pads with nulls.
    """
    p = players.withColumn("_z", F.arrays_zip(*[
        F.coalesce(c, F.array().cast("array<int>")).alias(c) for c in ("gold_t", "xp_t", "lh_t", "dn_t", "times")]))
    rows = p.select("contest_id", "player_slot", "start_time", "item_id", "account_id", "season_id",
                    F.posexplode("_z").alias("minute", "z"))
    any_curve = F.coalesce("z.gold_t", "z.xp_t", "z.lh_t", "z.dn_t").isNotNull()

    def zero(c: str) -> Column:
        return F.coalesce(F.col(f"z.{c}"), F.lit(0))

    return rows.filter(any_curve).select(
        "contest_id", "player_slot", "minute", "start_time", "item_id", "account_id", "season_id",
        zero("gold_t").alias("gold"), zero("xp_t").alias("xp"),
        F.least(zero("lh_t"), F.lit(MAX_SMALL)).alias("lh"), F.least(zero("dn_t"), F.lit(MAX_SMALL)).alias("dn"))


CHILD_TABLES = {
    "steps": decode_steps, "draft_timings": decode_draft_timings, "objectives": decode_objectives,
    "chat": decode_chat, "teamfights": decode_teamfights, "advantages": decode_advantages,
    "cosmetics": decode_cosmetics, "player_details": decode_player_details,
}
