"""Headline measurements: prints one JSON line.

BENCH_RUNS=1 times each query once; more runs add a warm-up and take the median of the rest.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from draftlake.registry import QUERIES  # noqa: E402
from draftlake.session import local_session  # noqa: E402

HEADLINE = [
    "team_item_profile_full_drafts", "pair_synergy_full_drafts", "pair_counter_full_drafts",
    "actor_team_history_full_drafts", "actor_item_profile_full_drafts", "team_item_profile_all_time",
    "pair_synergy_all_time", "top_partners", "head_to_head", "rosters", "season_at", "draft_validation", "draft_context",
    "draft_state", "candidates", "candidate_features", "recommendations", "replay_random", "replay_frequency",
    "decode_players", "expand_timeseries", "upsert_contests", "quarantine_replay",
]


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to compute every row and column of a query; the rows are not sent to the driver."""
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", shuffle_partitions=int(cpus) * 2, memory="16g")
    times = {}
    for n in names:
        run(spark, n, sf_dir) if runs > 1 else None
        times[n] = round(statistics.median(run(spark, n, sf_dir) for _ in range(max(1, runs - 1))), 3)
        print(f"{n} {times[n]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
