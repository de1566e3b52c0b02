"""Timings of the headline queries and loads; prints one JSON line.

Queries run warm and are written out whole to the noop sink; the median of three runs
counts. Loads write real files to a scratch store, once each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from suite import ALL_CASES
from suite.partitions import shipped
from suite.scd2 import ACCOUNTS, CUTOFF, changes, stamp
from suite.static import parts
from tidemark.config import PartitionTable, StaticTable
from tidemark.plans import jobs
from tidemark.session import build_session
from tidemark.sinks.store import Store

HEADLINE = (
    "range_scan incremental_scan missing_partitions initial_last_n_partitions partition_inventory "
    "partition_load_strategy inconsistent_partitions missing_data_analysis backfill_partitions "
    "latest_state scd2_batch_latest scd2_classify scd2_apply scd2_append_expire scd2_full_history "
    "scd2_full_history_split_keys backfill_scd scd2_violation_report scd2_repair "
    "scd2_rebuild_flags scd2_history_gaps table_checksum table_fingerprint_md5 "
    "table_fingerprint_sha256 text_row_hash table_diff merge_changes static_upsert "
    "pk_duplicate_count key_candidates decimal_overflow_rows decimal_compare quarantine_rows "
    "run_summary load_alerts validate_all"
).split()
RUNS = 3


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def load_times(spark, sf_dir: str) -> dict[str, float]:
    """Seconds of loads that write: first load, one partition replaced, next batch."""
    store = Store(spark, tempfile.mkdtemp(prefix="tidemark-bench-"))
    facts = PartitionTable("lineitem", "month")
    lines = shipped(spark, sf_dir).withColumn("month", F.floor(F.col("cobid") / 100).cast("int"))
    staged = []
    accounts = changes(spark, sf_dir)
    earlier = accounts.where(F.col("modified") < stamp(CUTOFF))
    codes = StaticTable("part", primary_keys=("p_partkey",), load_strategy="upsert")
    steps = {
        "load_partition_table": lambda: jobs.load_partition_table(store, facts, lines),
        "backfill_one_partition": lambda: jobs.backfill_partition_table(
            store, facts, lines, values=[199706]
        ),
        "stage_one_partition": lambda: staged.append(
            store.stage(lines.where("month = 199707"), "lineitem", "month", "bench")
        ),
        "switch_one_partition": lambda: store.publish(
            "lineitem", facts.kind, [store.switch("lineitem", "month", staged[0])], jobs.utc_now(), "bench"
        ),
        "load_scd2_first": lambda: jobs.load_scd2_table(store, ACCOUNTS, earlier),
        "load_scd2_next": lambda: jobs.load_scd2_table(store, ACCOUNTS, accounts),
        "load_static_table": lambda: jobs.load_static_table(store, codes, parts(spark, sf_dir)),
    }
    return {name: timed(step) for name, step in steps.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for key in wanted:

        def once(key=key):
            ALL_CASES[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()

        once()
        times[key] = statistics.median(timed(once) for _ in range(RUNS))
    if not sys.argv[1:]:
        times |= load_times(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
