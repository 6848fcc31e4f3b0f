"""Streaming runs over the events and over documents, and the fitted models."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from draftlake.functions.scalars import epoch_of
from draftlake.plans import evaluation as ev
from draftlake.plans import models
from draftlake.registry.core import query
from draftlake.registry.q_features import feature_frame
from draftlake.registry.sqlparts import sql
from draftlake.session import checkpoint_root
from draftlake.sources import star
from draftlake.sources.tables import load
from draftlake.streaming import dedup, ingest
from draftlake.streaming.quarantine import read_document_files
from draftlake.streaming.sinks import run_to_table


def _scratch(spark) -> str:
    """A fresh folder under the cluster's shared one; a temporary one only where none is named."""
    local = spark.sparkContext.master.startswith("local")
    root = checkpoint_root(spark, tempfile.gettempdir() if local else None)
    return f"{root}/draftlake-{uuid.uuid4().hex}"


def _event_stream(spark, d):
    schema = load(spark, d, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return e.select("event_id", "user_id", "event_type", "value", F.timestamp_seconds(epoch_of("ts")).alias("at"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, d):
    work = _scratch(spark)
    seen = dedup.dedup_stream(_event_stream(spark, d), ["user_id", "event_type"], "at")
    run_to_table(seen.select("user_id", "event_type"), f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").drop("batch_id")


@query("""SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, event_type AS stage,
    CASE WHEN value > 50 THEN 'failure' ELSE 'success' END AS kind, count(*) AS n FROM events GROUP BY 1, 2, 3""")
def stream_outcome_windows(spark, d):
    """Hourly outcome counts; of several updates of a window the newest counts."""
    work = _scratch(spark)
    e = _event_stream(spark, d).select("at", F.col("event_type").alias("stage"),
                                       F.when(F.col("value") > 50, "failure").otherwise("success").alias("kind"))
    run_to_table(dedup.outcome_windows(e, "at", "1 hour"), f"{work}/out", f"{work}/checkpoint", "update")
    return spark.read.parquet(f"{work}/out").groupBy("window_start", "stage", "kind").agg(
        F.max_by("n", "batch_id").alias("n"))


# Fixed value: an instant for streams that are fed step by step.
_T0 = 1_700_000_000


def _fed(spark, work: str, steps, transform, columns, mode: str = "append"):
    """Feed (rows, event time) one after the other, each in a run of its own that restarts from the checkpoint."""
    for rows, at in steps:
        rows.withColumn("at", F.timestamp_seconds(F.lit(at).cast("bigint"))).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(f"{columns}, at timestamp").parquet(f"{work}/in")
        run_to_table(transform(stream), f"{work}/out", f"{work}/checkpoint", mode)
    return spark.read.parquet(f"{work}/out").drop("batch_id")


@query(f"""SELECT DISTINCT user_id, t AS at FROM events, (VALUES ({_T0}), ({_T0 + 10 * 86400})) v(t)
    UNION ALL SELECT -1, {_T0 + 10 * 86400}""")
def stream_dedup_expiry(spark, d):
    """Users seen, seen again, a marker ten days on, seen late, seen on time after they were forgotten, and once more.

    The repetition within the day and the last one are dropped, the late rows too; a forgotten user counts as new.
    """
    users = load(spark, d, "events").select("user_id")
    marker = spark.createDataFrame([(-1,)], "user_id bigint")
    later = _T0 + 10 * 86400
    steps = [(users, _T0), (users, _T0 + 3600), (marker, later), (users, _T0 + 86400), (users, later), (users, later + 3600)]
    seen = _fed(spark, _scratch(spark), steps, lambda s: dedup.dedup_stream(s, "user_id", "at"), "user_id bigint")
    return seen.select("user_id", F.unix_seconds("at").alias("at"))


@query(f"""SELECT {_T0 - _T0 % 60} AS window_start, event_type AS stage, 'seen' AS kind, 2 * count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT {_T0 + 7200 - (_T0 + 7200) % 60}, 'marker', 'seen', 1
    UNION ALL SELECT {_T0 + 6900 - (_T0 + 6900) % 60}, event_type, 'seen', count(*) FROM events GROUP BY 2""")
def stream_outcome_late(spark, d):
    """Outcomes of one minute in two batches, a marker two hours on, the minute again (too late), and rows within the limit."""
    rows = load(spark, d, "events").select(F.col("event_type").alias("stage"), F.lit("seen").alias("kind"))
    marker = spark.createDataFrame([("marker", "seen")], "stage string, kind string")
    steps = [(rows, _T0), (rows, _T0 + 1), (marker, _T0 + 7200), (rows, _T0), (rows, _T0 + 6900)]
    work = _scratch(spark)
    _fed(spark, work, steps, lambda s: dedup.outcome_windows(s, "at", "1 minute", "10 minutes"), "stage string, kind string", "update")
    return spark.read.parquet(f"{work}/out").groupBy("window_start", "stage", "kind").agg(F.max_by("n", "batch_id").alias("n"))


@query("""SELECT 'contests' AS table_name, n_nationkey + 1 AS contest_id, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS reason FROM nation
      WHERE n_nationkey NOT IN (3, 7, 11)
    UNION ALL SELECT 'quarantine', 8, 'validate', 'negative_duration'
    UNION ALL SELECT 'quarantine', NULL, 'parse', 'undecodable'
    UNION ALL SELECT 'quarantine', 12, 'validate', 'invalid_player_slot'""")
def document_files(spark, d):
    """One document a file, three of them broken: the read goes on, and they are quarantined with their file."""
    work = _scratch(spark)
    k = F.col("n_nationkey")
    seat = F.struct(F.when(k == 11, 99).otherwise(0).alias("player_slot"), F.lit(1).alias("hero_id"))
    text = F.to_json(F.struct((k + 1).alias("match_id"), (F.lit(_T0) + k).alias("start_time"), F.when(k == 7, -1).otherwise(60).alias("duration"),
                              F.array(seat).alias("players")))
    load(spark, d, "nation").select(k.alias("file"), F.when(k == 3, '{"match_id": 4, "start').otherwise(text).alias("value")) \
        .repartition("file").write.partitionBy("file").text(f"{work}/in")
    good, bad = read_document_files(spark, f"{work}/in", _T0)
    none = F.lit(None).cast("string")
    return good.select(F.lit("contests").alias("table_name"), F.col("match_id").alias("contest_id"), none.alias("kind"), none.alias("reason")) \
        .unionByName(bad.select(F.lit("quarantine").alias("table_name"), "contest_id", "kind", "reason"))


@query(sql("contests", """SELECT event_id, user_id FROM events WHERE NOT EXISTS (
    SELECT 1 FROM contests WHERE contest_id = user_id AND side0_won)"""))
def stream_static_dedup(spark, d):
    """Streamed references without a stored, parsed contest."""
    work = _scratch(spark)
    refs = _event_stream(spark, d).select("event_id", "user_id", F.col("user_id").alias("contest_id"))
    stored = star.contests(spark, d).withColumn("is_parsed", F.coalesce("side0_won", F.lit(False)))
    run_to_table(dedup.unseen_refs(refs, stored).select("event_id", "user_id"), f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").drop("batch_id")


# Patterns of a whole draft in the three eras.
_PATTERNS = ("^B{0,7}P{2}B{0,3}P{6}B{0,4}P{2}$", "^B{0,4}P{4}B{0,6}P{4}B{0,4}P{2}$", "^B{0,4}P{6}B{0,6}P{4}$")
_PER_STEP = ("steps", "draft_timings", "objectives", "chat", "teamfights")


@query(sql("contests seq_steps seq_seats", f"""WITH codes AS (SELECT contest_id, count(*) AS n, count_if(is_pick) AS picks,
      string_agg(CASE WHEN is_pick THEN 'P' ELSE 'B' END, '' ORDER BY slot) AS code FROM seq_steps GROUP BY 1),
    checked AS (SELECT contests.*, CASE WHEN contest_id = 0 THEN 'invalid_contest_id' WHEN side0_won IS NULL AND lobby = 5 THEN 'start_time_missing'
        WHEN side0_won IS NULL AND lobby = 4 THEN 'negative_duration' WHEN side0_won IS NULL AND lobby = 2 THEN 'invalid_player_slot'
        WHEN side0_won IS NULL AND lobby = 1 THEN 'invalid_pick_side' WHEN n NOT BETWEEN 16 AND 24 THEN 'draft_length' WHEN picks <> 10 THEN 'draft_pick_count'
        WHEN NOT ({" OR ".join(f"regexp_matches(code, '{p}')" for p in _PATTERNS)}) THEN 'draft_pattern' END AS reason
      FROM contests JOIN codes USING (contest_id)),
    good AS (SELECT * FROM checked WHERE reason IS NULL), parsed AS (SELECT * FROM good WHERE lobby <> 3)
    SELECT 'contests' AS table_name, count(*) AS n FROM good
    UNION ALL SELECT 'sides', count_if(team0 <> 0) + count_if(team1 <> 0) FROM good
    UNION ALL SELECT 'players', count(*) FROM seq_seats SEMI JOIN good USING (contest_id)
    UNION ALL SELECT 'player_details', count(*) FROM seq_seats SEMI JOIN parsed USING (contest_id)
    {"".join(f"UNION ALL SELECT '{t}', count(*) FROM seq_steps SEMI JOIN parsed USING (contest_id) " for t in _PER_STEP)}
    UNION ALL SELECT 'timeseries', CAST(sum(player_slot % 128 + 2) AS BIGINT) FROM seq_seats SEMI JOIN parsed USING (contest_id)
    UNION ALL SELECT 'advantages', count(*) FROM parsed WHERE side0_won IS NOT NULL
    UNION ALL SELECT 'cosmetics', count(*) FROM parsed WHERE league_id > 0
    UNION ALL SELECT 'quarantine ' || reason, count(*) FROM checked WHERE reason IS NOT NULL GROUP BY reason"""))
def stream_ingest(spark, d):
    """All documents written as text files, streamed into the twelve tables with their drafts checked, and counted there."""
    work = _scratch(spark)
    star.contest_documents(spark, d, faulty=True, full_drafts=True).write.option("compression", "gzip").text(f"{work}/in")
    ingest.start_ingest(spark, f"{work}/in", f"{work}/out", f"{work}/checkpoint", 1_700_000_000, layout="quarters").awaitTermination()
    out = ingest.read_quarantine(spark, f"{work}/out").groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("quarantine "), "reason").alias("table_name"), "n")
    for name in ingest.POLICIES:
        table = ingest.current_table(spark, f"{work}/out", name)
        out = out.unionByName(table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n"))
    return out


@query()
def ranking_model(spark, d):
    """Weights of the pairwise ranker with its recall on the validation contests."""
    from draftlake.plans.decisions import split_by_contest
    # Read three times, twice for the fit and for the evaluation; only what the ranker reads is kept.
    frame = feature_frame(spark, d).select("contest_id", "slot", "item_id", "label", *models.RANKING_FEATURES)
    train, valid = split_by_contest(frame.persist(StorageLevel.MEMORY_AND_DISK))
    weights = models.fit_ranker(train)
    recall = ev.sampled_recall(models.rank_score(valid, weights))
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(w).alias("weight")) for f, w in weights.items()])
    return recall.select("recall", F.inline(rows))


@query()
def value_model(spark, d):
    """AUC and feature importances of the win classifier."""
    model, auc = models.fit_value(feature_frame(spark, d, n=0))
    weights = [float(x) for x in model.featureImportances.toArray()]
    picked = load(spark, d, "orders").agg(F.count(F.lit(1)).alias("n_contests"))
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(w).alias("importance"))
                     for f, w in zip(models.FEATURES, weights)])
    return picked.select("n_contests", F.lit(auc).alias("auc"), F.inline(rows))
