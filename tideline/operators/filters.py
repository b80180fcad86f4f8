"""Scans, ranges and choices of tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.model import SYSTEM_COLUMNS, CapturedTable
from tideline.operators.skew import GROUP_ROWS_PER_TASK, hot_groups, number_copies


def lsn_range(rows: DataFrame, low: str, high: str) -> DataFrame:
    """PF2: both ends inclusive; a plain column comparison, so it reaches the scan."""
    return rows.where(F.col("start_lsn").between(low, high))


def after_bookmark(rows: DataFrame, saved: str) -> DataFrame:
    """PF4: everything after a saved position. The same rows as ``>= saved + 1``."""
    return rows.where(F.col("start_lsn") > saved)


def change_scan(rows: DataFrame, table: CapturedTable, low: str, high: str) -> DataFrame:
    """SC1, PF1: the system columns and the captured columns of one range."""
    system = [c for c in SYSTEM_COLUMNS if c in rows.columns]
    return lsn_range(rows, low, high).select(*system, *table.column_names)


def row_state(rows: DataFrame, table: CapturedTable) -> DataFrame:
    """PF1: captured columns in ordinal order."""
    return rows.select(*table.column_names)


def choose_instances(rows: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = ()) -> DataFrame:
    """PF3: an empty include list means all; exclude wins."""
    include, exclude = list(include), list(exclude)
    if include:
        rows = rows.where(F.col("capture_instance").isin(include))
    if exclude:
        rows = rows.where(~F.col("capture_instance").isin(exclude))
    return rows


def missing_instances(catalog: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = ()) -> DataFrame:
    """JN6, ST1: configured names (either list) that the source does not have."""
    names = [(n,) for n in sorted({*include, *exclude})]
    configured = catalog.sparkSession.createDataFrame(names, "capture_instance string")
    return configured.join(catalog.select("capture_instance"), "capture_instance", "left_anti")


def strict_order(rows: DataFrame, hot_rows: int = GROUP_ROWS_PER_TASK) -> DataFrame:
    """SO1: log order; the command id separates statements of one transaction."""
    return _ordered(rows, ["start_lsn", "command_id", "seqval", "operation"], hot_rows)


def best_effort_order(rows: DataFrame, hot_rows: int = GROUP_ROWS_PER_TASK) -> DataFrame:
    """SO2: log order for tables without a command id."""
    return _ordered(rows, ["start_lsn", "seqval", "operation"], hot_rows)


def _ordered(rows: DataFrame, leading: list[str], hot_rows: int) -> DataFrame:
    # The log order leaves ties open. A hash of the other columns makes the result repeatable and lets the
    # range split divide a transaction whose rows share one sequence value; equal rows are only told apart
    # by number, and only if there are too many of them for one task.
    columns = rows.columns
    rest = [c for c in columns if c not in leading]
    order = list(leading)
    if hot_groups(rows, columns, hot_rows) is not None:
        rows, order = number_copies(rows), [*order, "__copy"]
    if rest:
        rows, order = rows.withColumn("__tie", F.xxhash64(*rest)), [*leading, "__tie", *order[len(leading) :]]
    return rows.orderBy(*order).select(*columns)
