"""Refresh of the stored profiles, and point-in-time snapshots."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftlake.operators.pairs import pair_counter, pair_synergy
from draftlake.operators.profiles import (
    DraftTables, actor_item_profile, actor_team_history, team_item_profile,
)
from draftlake.sources import files

VIEWS = {
    "team_item_profile": team_item_profile,
    "pair_synergy": pair_synergy,
    "pair_counter": pair_counter,
    "actor_team_history": actor_team_history,
    "actor_item_profile": actor_item_profile,
}


_REPORT = "view string, version string, status string, row_count bigint, error string"


def published_versions(spark: SparkSession, out: str) -> list[dict]:
    """Manifests of the complete versions, oldest first."""
    folder = f"{out}/_versions"
    return [json.loads(files.read_text(spark, f"{folder}/{n}")) for n in files.names(spark, folder) if n.endswith(".json")]


def current_version(spark: SparkSession, out: str) -> dict | None:
    """Manifest of the newest complete version (``version``, ``views`` with their rows), or None."""
    folder = f"{out}/_versions"
    done = [n for n in files.names(spark, folder) if n.endswith(".json")]
    return json.loads(files.read_text(spark, f"{folder}/{done[-1]}")) if done else None


def _publish(spark: SparkSession, out: str, version: str, views: dict[str, int]) -> None:
    """Append the manifest of a complete version; numbers are taken one by one, so two refreshes never share one."""
    number = len(published_versions(spark, out))
    while not files.publish_text(spark, f"{out}/_versions/{number:09d}.json", json.dumps({"version": version, "views": views}, sort_keys=True)):
        number += 1


def refresh_all(spark: SparkSession, t: DraftTables, as_of: str | None, out: str, version: str, views: dict | None = None) -> DataFrame:
    """Write every profile to ``out/<view>/version=<version>``; one result row per view.

    Each view is a job of its own. A failing one does not stop the others; its error is in the result, and the version
    is not published. Only when every view is complete, a manifest is added in one step, and readers, who follow
    ``current_version``, change from all views of the last version to all views of this one. A version once published
    is never written again: a repeated refresh reports it as it is.
    """
    done = next((m for m in published_versions(spark, out) if m["version"] == version), None)
    if done:
        return spark.createDataFrame([(n, version, "ok", rows, None) for n, rows in done["views"].items()], _REPORT)
    results = []
    for name, fn in (views or VIEWS).items():
        path = f"{out}/{name}/version={version}"
        try:
            fn(t, as_of).write.mode("overwrite").parquet(path)
            rows = spark.read.parquet(path).count()
            results.append((name, version, "ok", rows, None))
        except Exception as e:  # the report carries every error
            results.append((name, version, "failed", None, f"{type(e).__name__}: {e}"))
    if all(r[2] == "ok" for r in results):
        _publish(spark, out, version, {r[0]: r[3] for r in results})
    return spark.createDataFrame(results, _REPORT)


def read_view(spark: SparkSession, out: str, name: str, version: str | None = None) -> DataFrame:
    """One view of a version, by default the current one."""
    return read_views(spark, out, version, [name])[name]


def read_views(spark: SparkSession, out: str, version: str | None = None, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Views of one version, all of it or none: the manifest is looked up once for all of them."""
    found = current_version(spark, out) if version is None else next(
        (m for m in published_versions(spark, out) if m["version"] == version), None)
    if found is None:
        raise LookupError(f"no complete version {version or ''} under {out}")
    return {n: spark.read.parquet(f"{out}/{n}/version={found['version']}") for n in names or found["views"]}


def refresh_report(t: DraftTables, as_of: str | None) -> DataFrame:
    """Row count of every profile as a refresh would write it, as one lazy plan."""
    out = None
    for name, fn in VIEWS.items():
        part = fn(t, as_of).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("view"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def snapshot(profile: DataFrame, contests: DataFrame, at: str) -> DataFrame:
    """Actor profile rows stamped with the time and with the last three seasons' bounds."""
    newest = contests.agg(F.max("season_id").alias("m"))
    return profile.filter(F.col("games") >= 1).select(
        F.lit(at).cast("date").alias("snapshot_date"), "account_id", "item_id", "games", "wins", "shrunk_wr",
        (newest.scalar() - 2).alias("season_min"), newest.scalar().alias("season_max"))


def append_snapshot(profile: DataFrame, contests: DataFrame, at: str, path: str) -> None:
    """Replace the day's partition, so a retried run leaves one copy."""
    (snapshot(profile, contests, at).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot_date").parquet(path))
