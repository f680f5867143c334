"""Time the headline queries over whole tables; print one JSON line.

Each query runs twice to a sink that discards its rows; the second time counts,
so that the numbers do not hold the start of the JVM and of its compiler.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import queries
from checks.session import local_session

HEADLINE = (
    "net_extract", "enrich_final", "net_by_classifier", "level_d", "collapse_one_level",
    "legacy_adjust", "legacy_long", "reconcile_totals", "finest_level_keys",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
