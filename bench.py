"""Time the headline queries; print one JSON line.

BENCH_SF_DIR: tables to read (default /root/testdata/sf0.1).
BENCH_CPUS: cores of the local session (default all).
BENCH_REPEAT: timed runs per query, of which the median counts (default 3).
A timed run includes planning, checks of group sizes, and full evaluation.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tunefeed.plans.queries import QUERIES  # noqa: E402
from tunefeed.session import local_session  # noqa: E402

HEADLINE = [
    "sft_text",
    "render_chat",
    "to_messages",
    "sft_text_keep",
    "cap_tokens",
    "number_rows",
    "assign_step",
    "step_cap",
    "batch_summary",
    "pack_blocks",
    "feed_by_rank",
    "jsonl_roundtrip",
    "explode_metrics",
    "time_per_step",
    "final_metrics",
    "metric_rejects",
    "ckpt_retention",
    "run_tags",
    "metric_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, "tunefeed-bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        run(name)  # warm up: class loading and code generation
        times[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
