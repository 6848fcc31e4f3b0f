import json
import os

from pyspark.sql import functions as F

from draftlake.streaming import ingest, quarantine
from draftlake.streaming.dedup import dedup_stream
from draftlake.streaming.sinks import run_to_table

PLAYER = {"player_slot": 0, "hero_id": 4, "account_id": 9, "isRadiant": True, "win": 1}


def doc(k, parsed, **extra):
    p = {**PLAYER, "gold_t": [1, 2]} if parsed else PLAYER
    return {"match_id": k, "start_time": 1000 + k, "duration": 5, "radiant_team_id": 1, "dire_team_id": 2, "players": [p],
            "chat": [{"time": 1, "key": "hi"}], **extra}


def write(folder, name, docs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))


def state(spark, out):
    return {n: sorted(map(str, ingest.current_table(spark, out, n).collect())) for n in ingest.POLICIES}


def test_ingest_is_idempotent_and_upgrades(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    write(src, "a.json", [doc(1, False, radiant_win=True), doc(2, True, radiant_score=7), "not json", doc(0, True)])
    ingest.start_ingest(spark, src, out, ck, 1_700_000_000).awaitTermination()
    c = {r["contest_id"]: r for r in ingest.current_table(spark, out, "contests").collect()}
    assert set(c) == {1, 2} and not c[1]["is_parsed"] and c[2]["is_parsed"]
    assert [r["contest_id"] for r in ingest.current_table(spark, out, "chat").collect()] == [2]
    assert sorted(r["kind"] for r in ingest.read_quarantine(spark, out).collect()) == ["parse", "validate"]

    # A parsed version arrives for 1; an unparsed one for 2 changes nothing.
    write(src, "b.json", [doc(1, True, radiant_score=3), doc(2, False, radiant_score=99)])
    ingest.start_ingest(spark, src, out, ck, 1_700_000_000).awaitTermination()
    c = {r["contest_id"]: r for r in ingest.current_table(spark, out, "contests").collect()}
    assert c[1]["is_parsed"] and c[1]["side0_won"] and c[1]["score0"] == 3 and c[2]["score0"] == 7
    before = state(spark, out)

    # The same documents again, and a compaction, leave the tables as they are.
    write(src, "c.json", [doc(1, True, radiant_score=3), doc(2, True, radiant_score=7)])
    ingest.start_ingest(spark, src, out, ck, 1_700_000_000).awaitTermination()
    assert state(spark, out) == before
    ingest.compact(spark, out)
    assert state(spark, out) == before
    write(src, "d.json", [doc(3, True)])
    ingest.start_ingest(spark, src, out, ck, 1_700_000_000).awaitTermination()
    after = state(spark, out)
    assert len(after["contests"]) == 3 and set(before["contests"]) < set(after["contests"])


def test_bad_drafts_are_quarantined(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    steps = [{"order": i, "is_pick": x == "P", "hero_id": i + 1, "team": i % 2} for i, x in enumerate("PB" * 10)]
    write(src, "a.json", [doc(1, True, game_mode=2, picks_bans=steps), doc(2, True, game_mode=1, picks_bans=steps)])
    ingest.start_ingest(spark, src, out, ck, 1_700_000_000).awaitTermination()
    q = ingest.read_quarantine(spark, out).collect()
    assert [(r["contest_id"], r["kind"], r["reason"]) for r in q] == [(1, "draft_schema", "draft_pattern")]
    assert [r["contest_id"] for r in ingest.current_table(spark, out, "contests").collect()] == [2]


def test_dedup_over_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    for b, keys in enumerate(([1, 2, 2], [2, 3])):
        spark.createDataFrame([(k,) for k in keys], "k int").withColumn(
            "at", F.timestamp_seconds(F.lit(1_700_000_000 + b))).write.mode("append").parquet(src)
        s = spark.readStream.schema("k int, at timestamp").parquet(src)
        run_to_table(dedup_stream(s, "k", "at").select("k"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_quarantine_replay(spark):
    q = spark.createDataFrame(
        [("a", 1, 10, 2), ("b", 1, 20, 2), ("c", 2, 30, 2), ("d", None, 40, 2), ("e", 3, 1, 2)],
        "quarantine_id string, contest_id bigint, received_at bigint, retries int")
    guard = spark.createDataFrame([(2, 1_000)], "contest_id bigint, replayed_at bigint")
    replayed, remaining, marks = quarantine.replay_quarantine(q, guard, 2_000, 4)
    assert sorted((r["quarantine_id"], r["retries"]) for r in replayed.collect()) == [("b", 0), ("d", 0)]
    assert sorted(r["quarantine_id"] for r in remaining.collect()) == ["a", "c", "e"]
    assert [r["contest_id"] for r in marks.collect()] == [1]
    old = spark.createDataFrame([(2, 1_000)], "contest_id bigint, replayed_at bigint")
    late, _, _ = quarantine.replay_quarantine(q, old, 1_000 + 8 * 86400, 4)
    assert "c" in {r["quarantine_id"] for r in late.collect()}
