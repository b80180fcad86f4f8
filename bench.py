"""Headline timings on one machine; prints one JSON line.

Each query is run once to warm up and then three times; the median counts. ``full_run`` is a whole incremental
run of both captured tables: plan, pair, write JSON lines, manifest, bookmarks.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame

from tests.sessions import local_session
from tideline.plans.incremental import RunOptions, run_incremental
from tideline.plans.queries import QUERIES
from tideline.sources.change_tables import ChangeSource
from tideline.sources.fixtures import ORIGIN, Fixtures

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
HEADLINES = (
    "change_events",
    "full_envelope",
    "tombstones",
    "single_changes",
    "multi_instance_events",
    "window_plan",
    "window_counts",
    "capture_catalog",
    "snapshot_events",
    "resume_plan",
    "strict_order",
    "before_after",
    "snapshot_serial",
)


def timed(action) -> float:
    action()
    took = []
    for _ in range(REPEATS):
        began = time.perf_counter()
        action()
        took.append(time.perf_counter() - began)
    return round(statistics.median(took), 3)


def landed(rows: DataFrame, path: Path) -> DataFrame:
    """What a run reads: change tables that already exist as files."""
    rows.repartition(8).write.parquet(str(path))
    return rows.sparkSession.read.parquet(str(path))


def main() -> None:
    spark = local_session()
    fixtures = Fixtures(spark, SF_DIR)
    target = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    log = fixtures.both.select("start_lsn").distinct().join(fixtures.lsn_time, "start_lsn", "left")
    log = landed(log, target / "log")
    sources = [ChangeSource(s.table, landed(s.changes, target / s.table.capture_instance)) for s in fixtures.sources]
    runs = iter(range(1000))

    def full_run() -> None:
        at = target / str(next(runs))
        run_incremental(
            spark,
            sources,
            ORIGIN,
            str(at / "out"),
            str(at / "marks"),
            log,
            started_at=datetime(2026, 1, 2, tzinfo=timezone.utc),
            options=RunOptions(snapshot_mode="never"),
        )

    def query(name: str):
        return lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    seconds = {name: timed(query(name)) for name in HEADLINES}
    seconds["full_run"] = timed(full_run)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
