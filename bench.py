"""Bench: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each job is planned and fully executed into Spark's ``noop`` sink (no
collect to the driver); time = wall seconds per job, planning included.
Before timing, one untimed warm-up pass runs the same jobs on the smallest
scale factor next to $BENCH_SF_DIR (JIT and Spark's generated-code cache
warm, as in a long-running cluster session); set BENCH_WARMUP=0 to skip it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["page_title", "page_text", "raw_links", "page_markdown", "link_inventory", "page_extract",
            "feed_entries", "redirect_resolve", "host_rule_match", "header_map"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from webloom.plans.jobs import JOBS
    from webloom.session import build_session
    spark = build_session(f"local[{cpus}]", app="webloom-bench", shuffle_partitions=int(cpus) * 2)
    # warm-up: JVM, parquet reader, codegen caches (untimed, smallest scale factor)
    spark.read.parquet(f"{sf_dir}/pages.parquet").write.format("noop").mode("overwrite").save()
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warm_dir):
        for name in HEADLINE:
            JOBS[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
