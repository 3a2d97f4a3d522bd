"""Time the headline queries on one machine; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS (default 2, the
faster run counts) come from the environment. Results go to a sink that keeps nothing, so every row and
column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from delaylake.plans.queries import QUERIES  # noqa: E402
from delaylake.session import local_session  # noqa: E402

HEADLINE = (
    "delay_features",
    "delay_by_origin_block",
    "staging_flights",
    "analytics_flights",
    "enrich_weather",
    "enrich_codes",
    "join_inner",
    "join_left",
    "join_right",
    "join_outer",
    "semi_delayed",
    "reconcile_predictions",
    "dedupe_last",
    "dedupe_none",
    "newest_version",
    "null_rates",
    "readiness_gate",
    "deployment_kpis",
    "lookup_predictions",
    "classifier_metrics",
    "split_balance",
    "flight_json_flatten",
    "weather_arrays",
    "upsert_predictions",
    "snapshot_replace_raw",
    "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once(names[0])  # starts the JVM's compilers; not counted
    timings = {name: round(min(once(name) for _ in range(runs)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
