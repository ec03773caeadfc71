"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Each query is run
whole, with every result column produced and none kept. Names on the command
line replace the default list.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from matchloom.catalog import QUERIES  # noqa: E402
from matchloom.session import local_session  # noqa: E402

HEADLINE = [
    "top_players", "int_match_player_stats", "fact_player_map_stats", "fact_matches", "dim_players", "dim_maps",
    "int_player_current_team", "upsert_matches", "upsert_maps", "upsert_players", "map_discovery_upsert",
    "cascade_delete", "claim_batch", "state_replay", "state_replay_requeue", "attempt_outcome", "stage_outcome",
    "scd2_backfill", "fact_roster_asof", "player_team_history", "team_map_win_rate", "player_match_stats",
    "map_highlights", "dq_unique_combo_failures", "dq_base_rules", "dq_grain_flow", "page_links", "page_triage",
    "result_links", "match_pages", "stream_state_replay", "stream_upsert", "dq_suite_report", "scd2_history",
    "map_pages_players", "ingest_match_pages", "upsert_idempotent",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    # The first job of a session pays for class loading and code generation.
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
