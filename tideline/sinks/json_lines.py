"""SK1-SK3, SK8: events as JSON lines, visible once the manifest of their run exists.

Layout: ``<path>/events/run_id=…/topic=…[/year=…/month=…/day=…]/window=<from>_<to>/part-….txt.gz``. A window
may span several part files; their names sort in event order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import levels_of_first_file
from tideline.sinks.manifest import read_runs

LINE_ORDER = ("start_lsn", "command_key", "seqval", "serial", "tombstone")

_LEVELS = ("run_id", "topic", "year", "month", "day", "window")


def date_columns(started_at: datetime, by_date: bool) -> dict[str, str]:
    """Date levels of the run, taken from its start."""
    return {"year": f"{started_at:%Y}", "month": f"{started_at:%m}", "day": f"{started_at:%d}"} if by_date else {}


def run_folder(path: str, run_id: str) -> str:
    return f"{path}/events/run_id={run_id}"


def write_lines(
    lines: DataFrame,
    path: str,
    run_id: str,
    levels: Sequence[str],
    compress: bool = True,
    ordered: bool = True,
    parts: int | None = None,
) -> None:
    """Write ``value`` below the folder ``levels``, files in log order unless ``ordered`` is off.

    With ``parts``, each line says in ``part`` which of so many tasks writes it (see ``windows.file_parts``), and lines are
    read once. Without, Spark samples the lines for ranges of the log order, so they are read twice; ranges also split a window
    that holds one very large transaction.
    """
    levels = list(levels)
    if parts is not None:
        lines = lines.repartitionById(parts, "part").sortWithinPartitions(*levels, *LINE_ORDER)
    elif ordered:
        lines = lines.repartitionByRange(*levels, *LINE_ORDER).sortWithinPartitions(*levels, *LINE_ORDER)
    (
        lines.select(*levels, "value")
        .write.mode("append")
        .partitionBy(*levels)
        .option("compression", "gzip" if compress else "none")
        .text(run_folder(path, run_id))
    )


def read_all_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line below a path, with its folder levels as text columns, null where a run has no such level.

    Levels are declared as text, so a run id ``007`` or a day ``01`` comes back as it was written.
    """
    found = levels_of_first_file(spark, f"{path}/events")
    if found is None:
        return spark.createDataFrame([], ", ".join(f"`{name}` string" for name in ("value", *_LEVELS)))
    there = [name for name in _LEVELS if name in found]
    # Spark lists the folders once; it refuses runs whose levels differ.
    return spark.read.schema(", ".join(f"`{name}` string" for name in ("value", *there))).text(f"{path}/events")


def read_complete_lines(spark: SparkSession, path: str) -> DataFrame:
    """SK8: only lines of runs that have a manifest.

    The ids of the published runs (one small row each) become literals on the run's folder level, so the files of
    other runs are not opened.
    """
    published = [r["run_id"] for r in read_runs(spark, path).select("run_id").distinct().collect()]
    return read_all_lines(spark, path).where(F.col("run_id").isin(published))


def complete_runs(output: DataFrame, runs: DataFrame) -> DataFrame:
    """SK8: output of a run counts only when its manifest exists."""
    return output.join(runs.select("run_id"), "run_id", "left_semi")
