"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query runs twice into a sink
that discards its rows; the better time counts, so that JVM warm-up does not.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "augment_and_scan",
    "c2_synonym_replacement",
    "c7_back_translation",
    "c8_contextual_insertion",
    "c9_text_augmentation",
    "f1_pii_scan",
    "f7_license_report",
    "b2_encode",
    "b4_pack_sequences",
    "b7_assign_batches",
    "d6_cutmix",
    "e2_mix_external",
    "g7_improved",
    "g10_running_average",
    "h3_sequential_gate",
    "h9_stats",
    "i2_merge_configs",
    "i6_validate_tuning",
    "j2_score_lm",
    "j4_trial_sweep",
    "k1_stream_metric_tracker",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from trialweave.catalog import all_queries
    from trialweave.plans.session import build_session

    scratch = tempfile.mkdtemp(prefix="trialweave-bench-")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, memory="16g", scratch=scratch)
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    for name in names:
        best = None
        for _ in range(2):
            start = time.time()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.time() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf})
    )
    spark.stop()


if __name__ == "__main__":
    main()
