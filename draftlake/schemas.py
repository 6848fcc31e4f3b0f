"""Schemas of the nested contest document. Field names and types of the format."""

from __future__ import annotations

from pyspark.sql import types as T

CONTEST_FIELDS = """match_id bigint, match_seq_num bigint, start_time bigint, duration int, radiant_win boolean,
tower_status_radiant int, tower_status_dire int, barracks_status_radiant int, barracks_status_dire int,
radiant_score int, dire_score int, first_blood_time int, lobby_type int, game_mode int, cluster int, region int,
skill int, engine int, human_players int, version int, patch int, positive_votes int, negative_votes int,
leagueid int, series_id int, series_type int, radiant_team_id bigint, dire_team_id bigint,
radiant_captain bigint, dire_captain bigint, replay_salt bigint, replay_url string, pauses string, cosmetics string"""

PLAYER_FIELDS = """player_slot int, account_id bigint, hero_id int, hero_variant int, isRadiant boolean, win int,
patch int, lobby_type int, game_mode int, rank_tier int, kills int, deaths int, assists int, level int,
net_worth int, gold int, gold_spent int, gold_per_min int, xp_per_min int, last_hits int, denies int,
hero_damage int, tower_damage int, hero_healing int, item_0 int, item_1 int, item_2 int, item_3 int, item_4 int,
item_5 int, item_neutral int, backpack_0 int, backpack_1 int, backpack_2 int, backpack_3 int, lane int,
lane_role int, is_roaming boolean, party_id int, party_size int, stuns float, obs_placed int, sen_placed int,
creeps_stacked int, camps_stacked int, rune_pickups int, firstblood_claimed int, teamfight_participation float,
towers_killed int, roshans_killed int, observers_placed int, leaver_status int, gold_t array<int>,
xp_t array<int>, lh_t array<int>, dn_t array<int>, times array<int>, throw int, comeback int, loss int,
win_gold int"""

# Sub-documents of a player that are carried as JSON text.
PLAYER_BLOBS = """damage damage_taken damage_inflictor damage_inflictor_received damage_targets hero_hits max_hero_hit
ability_uses ability_targets ability_upgrades_arr item_uses gold_reasons xp_reasons killed killed_by kill_streaks
multi_kills life_state lane_pos obs sen actions pings runes purchase obs_log sen_log obs_left_log sen_left_log
purchase_log kills_log buyback_log runes_log connection_log permanent_buffs neutral_tokens_log
neutral_item_history additional_units cosmetics benchmarks all_word_counts my_word_counts""".split()

STEP_FIELDS = "`order` int, is_pick boolean, hero_id int, team int"
TIMING_FIELDS = ("`order` int, pick boolean, active_team int, hero_id int, player_slot int, extra_time int, "
                 "total_time_taken int")
OBJECTIVE_FIELDS = "time int, type string, slot int, player_slot int, team int, key variant, value int, unit string"
CHAT_FIELDS = "time int, type string, player_slot int, unit string, key string"
TEAMFIGHT_FIELDS = "end int, last_death int, deaths int, players string"

def _array_of(fields: str) -> str:
    return "array<struct<" + ", ".join(":".join(f.strip().split(" ")) for f in fields.split(",")) + ">>"


_PLAYERS = _array_of(PLAYER_FIELDS + ", " + ", ".join(f"{b} string" for b in PLAYER_BLOBS))
DOCUMENT_DDL = f"""{CONTEST_FIELDS}, players {_PLAYERS}, picks_bans {_array_of(STEP_FIELDS)},
draft_timings {_array_of(TIMING_FIELDS)}, objectives array<string>, chat {_array_of(CHAT_FIELDS)},
teamfights {_array_of(TEAMFIGHT_FIELDS)}, radiant_gold_adv array<int>, radiant_xp_adv array<int>"""


def document_schema() -> T.StructType:
    return T.StructType.fromDDL(DOCUMENT_DDL)
