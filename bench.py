"""Benchmark the headline queries.

Runs each query of HEADLINE at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] and prints one JSON line. Each query is executed in
full with the ``noop`` sink (no collect to the driver); one warm-up pass
runs first, then the median of $BENCH_REPEAT timed passes is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from docketline.plans.queries import QUERIES  # noqa: E402
from docketline.session import build_session  # noqa: E402

HEADLINE = [
    "courtbook_rows", "split_parts_300", "html_to_text", "first_line", "part_table",
    "chronology_sheet", "chronology_payload", "merge_back", "recombine_parts",
    "sse_fold", "change_detect", "resubmit_reject", "batch_manifest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2)
    times: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
