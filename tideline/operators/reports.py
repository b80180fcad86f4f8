"""Catalogue, ordering readiness and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.errors import OrderingNotReady
from tideline.operators.extents import lsn_extent

# Run modes.
STRICT_MODE, BEST_EFFORT_MODE = "change_table_command_id", "change_table_best_effort"


def capture_catalog(rows: DataFrame) -> DataFrame:
    """SC3, SC9: captured tables with their retained range, in name order. Summed up before the shuffle."""
    one = F.lit(1).cast("bigint")
    with_id = F.col("command_id").isNotNull().cast("bigint")
    return lsn_extent(rows, ["capture_instance"], change_rows=one, rows_with_command_id=with_id).orderBy("capture_instance")


def ordering_report(catalog: DataFrame) -> DataFrame:
    """MD1, AG7: tables and whether their changes can be ordered strictly."""
    return catalog.select(
        "capture_instance", (F.col("rows_with_command_id") > 0).alias("has_command_id"), "change_rows"
    )


def require_ordering(report: DataFrame) -> None:
    """MD1, strict: refuse tables without a command id."""
    missing = report.where(~F.col("has_command_id")).orderBy("capture_instance").limit(20).collect()
    if missing:
        raise OrderingNotReady("no command id in: " + ", ".join(r["capture_instance"] for r in missing))


def extractor_mode(report: DataFrame) -> DataFrame:
    """AG6: strict only if there is a table and all of them have a command id."""
    every = F.coalesce(F.every("has_command_id"), F.lit(False))
    return report.agg(F.when(every, STRICT_MODE).otherwise(BEST_EFFORT_MODE).alias("mode"))


def source_report(runs: DataFrame) -> DataFrame:
    """MS2: outcome per source. ``runs`` has ``source``, ``status``, ``files_written``, ``total_records``."""
    return runs.groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.sum("files_written").alias("files_written"),
        F.sum("total_records").alias("total_records"),
        F.when(F.count_if(F.col("status") == "failed") > 0, "failed").otherwise("success").alias("status"),
    )
