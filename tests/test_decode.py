import json

from draftlake.functions.scalars import flex_epoch
from draftlake.operators import decode, dimensions, filters
from draftlake.sources import envelopes
from draftlake.sources.documents import parse_documents
from pyspark.sql import functions as F

DOC = {
    "match_id": 7001, "start_time": 1690001111, "duration": 2345, "game_mode": 2,
    "picks_bans": [{"is_pick": True, "hero_id": 14, "team": 0, "order": 0}, {"is_pick": False, "hero_id": 86, "team": 1, "order": 1}],
    "draft_timings": [{"order": 1, "pick": True, "active_team": 2, "hero_id": 0, "player_slot": 1, "extra_time": 17,
                       "total_time_taken": 31}],
    "objectives": [{"time": 10, "type": "x", "slot": 1, "key": "3", "player_slot": 1}, 5,
                   {"time": 11, "type": "y", "key": 7}, {"time": 12, "type": "z", "key": 1.5}],
    "chat": [{"time": 1, "type": "chat", "key": "well played", "player_slot": 1}],
    "radiant_gold_adv": [0, -70, 415], "radiant_xp_adv": [0, 33, -8, 61],
    "teamfights": [{"start": 1, "end": 2, "last_death": 2, "deaths": 3, "players": [{"a": 1}]}],
    "players": [{"player_slot": 1, "hero_id": 1, "account_id": 880044, "isRadiant": True, "times": [0, 60, 120],
                 "gold_t": [0, 210, 655], "lh_t": [0, 4, 50000], "dn_t": [0, 0, 3], "xp_t": [0, 95, 480],
                 "killed": {"u": 1}, "purchase_log": [{"time": 1}]}],
}


def docs(spark, *values):
    return parse_documents(spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "raw string"))


def test_fixture_document(spark):
    d = docs(spark, DOC)
    c = decode.decode_contests(d).first()
    assert (c["contest_id"], c["duration"], c["is_parsed"], c["side0_won"], c["score0"]) == (7001, 2345, True, None, None)
    assert decode.decode_contests(d, absent_as_zero=True).first()["score0"] == 0
    p = decode.decode_players(d).first()
    assert (p["account_id"], p["side"], p["won"]) == (880044, 0, None)
    assert decode.decode_players(d, absent_as_zero=True).first()["won"] is False
    assert decode.decode_player_details(d).first()["killed"] == '{"u":1}'
    assert decode.decode_draft_timings(d).first()["item_id"] is None
    assert [r["key"] for r in decode.decode_objectives(d).orderBy("time").collect()] == ["3", "7", ""]
    assert decode.decode_advantages(d).first()["gold_adv"][2] == 415
    assert json.loads(decode.decode_teamfights(d).first()["players"]) == [{"a": 1}]
    ts = decode.expand_timeseries(decode.decode_players(d)).orderBy("minute").collect()
    assert [(r["gold"], r["xp"], r["lh"], r["dn"]) for r in ts] == [(0, 0, 0, 0), (210, 95, 4, 0), (655, 480, 32767, 3)]


def test_unequal_curves_and_times_only(spark):
    doc = {**DOC, "players": [{"player_slot": 1, "hero_id": 1, "times": [0, 60], "gold_t": [1, 2, 3]},
                              {"player_slot": 2, "hero_id": 1, "times": [0, 60], "gold_t": []}]}
    rows = decode.expand_timeseries(decode.decode_players(docs(spark, doc))).collect()
    assert sorted((r["player_slot"], r["minute"], r["gold"]) for r in rows) == [(1, 0, 1), (1, 1, 2), (1, 2, 3)]


def test_validation(spark):
    bad_slot = {**DOC, "players": [{"player_slot": 99, "hero_id": 1}]}
    values = [DOC, {"match_id": 0}, {"match_id": 5}, bad_slot, {**DOC, "duration": -1},
              {**DOC, "picks_bans": [{"team": 3}]}, {**DOC, "players": [{"player_slot": 1, "hero_id": -1}]}]
    absent = {**DOC, "picks_bans": [{"hero_id": 3}], "players": [{"hero_id": 3}]}
    ok, rejected = filters.validate_contests(docs(spark, *values, absent))
    assert ok.count() == 2
    assert sorted(r["reason"] for r in rejected.collect()) == sorted([
        "invalid_contest_id", "start_time_missing", "invalid_player_slot", "negative_duration", "invalid_pick_side",
        "invalid_item_id"])


def test_reference_envelope(spark):
    df = spark.createDataFrame([('{"rows":[{"match_ids":[42,"43",0,"invalid"]}]}',),
                                ('{"rows":[{"match_id":"7","start_time":"1704067200"},{"match_id":-1}]}',), ("junk",)], "j string")
    rows = envelopes.parse_ref_envelope(df, "j").collect()
    assert sorted(tuple(r) for r in rows) == [(7, 1704067200), (42, 0), (43, 0)]


def test_entity_envelope_skips_bad_rows(spark):
    df = spark.createDataFrame([('{"rows":[{"id":1,"name":"a"},{"id":0},"x",{"name":"b"}]}',)], "j string")
    assert [r["id"] for r in envelopes.parse_entity_envelope(df, "j", "id bigint, name string", "id").collect()] == [1]


def test_dates(spark):
    cases = ["1691539200", '"1691539200"', '"2023-08-09T00:00:00Z"', '"2023-08-09"', "[1691539200]", "null", '"soon"']
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r["e"] for r in df.select(flex_epoch(F.parse_json("t")).alias("e")).collect()]
    assert got == [1691539200] * 5 + [None, None]


def test_kit_documents(spark):
    text = json.dumps({"h": {"abilities": ["a", ["b", "c"], "generic_hidden", None],
                             "talents": [{"name": "t", "level": 5}, {"name": "u", "level": 4}],
                             "facets": [{"id": 1, "name": "f", "deprecated": "x"}, {"id": 2, "name": ""}]}})
    df = spark.createDataFrame([(text,)], "j string")
    assert sorted((r["slot"], r["ability"]) for r in dimensions.build_item_abilities(df, "j").collect()) == [(0, "a"), (1, "b")]
    assert [r["ability"] for r in dimensions.build_item_talents(df, "j").collect()] == ["u"]
    assert [(r["slot"], r["deprecated"]) for r in dimensions.build_item_facets(df, "j").collect()] == [(1, True)]
