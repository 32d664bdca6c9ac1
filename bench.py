"""Benchmark the headline queries.

Runs the analyses that correspond to the published timings (Q1 native /
UDF, Q2 DataFrame / SQL, Q3 with each join hint, Q4 nearest site, Q5 area
rates and correlations) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.

Each query is timed from building its plan (including any small planning
jobs it runs) to having its full result on the driver as an Arrow table.  The JVM
and Python workers are warmed up first; every query runs ``$BENCH_REPEAT``
times (default 3) and the fastest run is reported.  ``value`` is the sum of
the headline queries.  Set ``BENCH_ALL=1`` to also time every other
registered query (reported under ``extra``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.queries import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402

# Headline name -> registered query (names follow the published timing rows).
HEADLINE = {
    "q1_native": "band_counts",
    "q1_udf": "band_counts_udf",
    "q2_df": "topn_share_text",
    "q2_sql": "topn_share_sql",
    "q3_broadcast": "join_hint_broadcast",
    "q3_merge": "join_hint_merge",
    "q3_shuffle_hash": "join_hint_shuffle_hash",
    "q3_replicate_nl": "join_hint_replicate_nl",
    "q4_nearest_site": "nearest_site_summary",
    "q5_area_rates": "zone_rates",
    "q5_correlations": "rate_correlation",
}


def _time(spark, name: str, base: str, repeat: int) -> float:
    best = float("inf")
    for _ in range(repeat):
        t0 = time.perf_counter()
        QUERIES[name](spark, base).toArrow()
        best = min(best, time.perf_counter() - t0)
    return best


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(
        "tessera-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(2 * cpus, 4),
        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "4g"),
    )
    # Warm-up: start executors' Python workers and JIT the common paths.
    QUERIES["band_counts_udf"](spark, base).collect()
    QUERIES["moments"](spark, base).collect()

    times = {k: round(_time(spark, q, base, repeat), 3) for k, q in HEADLINE.items()}
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "repeat": repeat,
    }
    if os.environ.get("BENCH_ALL"):
        done = set(HEADLINE.values())
        out["extra"] = {q: round(_time(spark, q, base, repeat), 3) for q in QUERIES if q not in done}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
