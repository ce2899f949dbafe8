"""Headline queries, timed end to end; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. The contract tables are derived and written first, as the
engine's input is meant to come ("prepare_sec", not in the total). Then every
query computes all its rows from those files: one run warms the JVM, the better
of two more counts.
"""

from __future__ import annotations

import json
import os
import time

from tagwright.plans.registry import REGISTRY
from tagwright.plans.sample import TABLES, Sample
from tagwright.session import local_session, release_scratch, scratch

HEADLINE = (
    "label_rows",
    "prepared_tags",
    "validation",
    "join_match_counts",
    "completeness",
    "chain_distribution",
    "language_distribution",
    "label_set_stats",
    "one_per_key",
    "label_page",
    "label_deep_page",
    "batch_bounds",
    "duplicate_addresses",
    "batch_running_rate",
    "batch_payload_sizes",
    "ledger_state",
    "unsent_labels",
    "ledger_transitions",
    "file_problems",
    "file_digests",
)


def run(sample: Sample, name: str) -> float:
    """Seconds to plan the query and compute all its rows."""
    fresh = Sample(sample.spark, sample.sf_dir)
    for table in TABLES:
        setattr(fresh, table, getattr(sample, table))
    with scratch(sample.spark):
        started = time.perf_counter()
        REGISTRY[name].build(fresh).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    started = time.perf_counter()
    sample = Sample(spark, sf_dir).written()
    prepare = time.perf_counter() - started
    for name in HEADLINE:
        run(sample, name)
    seconds = {name: round(min(run(sample, name) for _ in range(2)), 3) for name in HEADLINE}
    release_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "prepare_sec": round(prepare, 3),
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
