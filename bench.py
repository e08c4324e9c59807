"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, writing results to the ``noop`` sink (full
execution, no output cost).  One warm-up pass, then the median of
``$BENCH_RUNS`` (default 3) timed passes per query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from elcorpus import registry as R  # noqa: E402
from elcorpus.session import local_session  # noqa: E402

HEADLINE = {
    "html_tokens": "html_tokens",
    "paragraphs": "paragraphs",
    "link_graph": "page_links",
    "clean_pages": "clean_pages",
    "entity_features": "entity_features",
    "build_dataset": "entities",
}


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = R.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="elcorpus-bench")
    out = {}
    for label, name in HEADLINE.items():
        run_once(spark, name, sf_dir)                      # warm-up
        times = [run_once(spark, name, sf_dir) for _ in range(runs)]
        out[label] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
