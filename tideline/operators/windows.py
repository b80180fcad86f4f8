"""Cutting a pending range into windows of whole transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.functions.lsn import following
from tideline.operators.extents import lsn_extent
from tideline.operators.skew import number_rows
from tideline.session import numbers, stage

# Fixed value: default number of transactions per window.
WINDOW_SIZE = 5000


def distinct_positions(rows: DataFrame) -> DataFrame:
    """AG8: every transaction once per table; duplicates vanish before the shuffle."""
    return rows.select("capture_instance", "start_lsn").distinct()


def window_plan(rows: DataFrame, size: int = WINDOW_SIZE) -> DataFrame:
    """WN1: window number (from 0) of every transaction, ``size`` transactions per window.

    All windows of all tables are planned at once. A table of any size is numbered by ranges of its
    positions, never by one task.
    """
    numbered = number_rows(distinct_positions(rows), ["capture_instance"], ["start_lsn"], "__n", unique=True)
    window = F.call_function("div", F.col("__n") - 1, F.lit(size).cast("bigint"))
    return numbered.select("capture_instance", "start_lsn", window.alias("window_id"))


class WindowLedger:
    """WN1, WN2 over runs: a window plan that goes on where the last run left it.

    ``plan/batch=n`` has the positions that batch ``n`` numbered, ``ends/batch=n`` the last position of each table and how
    many were numbered up to it. A batch reads only the ends of those before it, and sorts only positions above them; positions at
    or below an end are known or late, and late ones no run reads (see ``late_rows``). A repeated batch replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, size: int = WINDOW_SIZE) -> None:
        self.spark, self.path, self.size = spark, path, size

    def ends(self, before: int) -> DataFrame:
        """The last numbered position of every table and its number, as the batches before one have left them."""
        schema = "capture_instance string, last_lsn string, numbered bigint, batch bigint"
        if not [n for n in numbers(self.spark, f"{self.path}/ends") if n < before]:
            return self.spark.createDataFrame([], "capture_instance string, last_lsn string, numbered bigint")
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/ends").where(F.col("batch") < before)
        last = F.max(F.struct("numbered", "last_lsn"))
        return rows.groupBy("capture_instance").agg(last.alias("e")).select("capture_instance", "e.last_lsn", "e.numbered")

    def extend(self, rows: DataFrame, batch: int) -> DataFrame:
        """Number the positions of ``rows`` that are above the stored ends; returns the plan of this batch."""
        known = stage(self.ends(batch), "window-ends")  # one row per table
        fresh = distinct_positions(rows).join(F.broadcast(known), "capture_instance", "left")
        fresh = fresh.where("last_lsn IS NULL OR start_lsn > last_lsn").select(
            "capture_instance", "start_lsn", F.coalesce("numbered", F.lit(0)).alias("__before")
        )
        numbered = number_rows(fresh, ["capture_instance"], ["start_lsn"], "__n", unique=True)
        n = F.col("__before") + F.col("__n")
        window = F.call_function("div", n - 1, F.lit(self.size).cast("bigint"))
        plan = numbered.select("capture_instance", "start_lsn", window.alias("window_id"), n.alias("number"))
        plan.write.mode("overwrite").parquet(f"{self.path}/plan/batch={batch}")
        written = self.spark.read.schema(plan.schema).parquet(f"{self.path}/plan/batch={batch}")
        ends = lsn_extent(written, ["capture_instance"], added=F.lit(1).cast("bigint")).join(F.broadcast(known), "capture_instance", "left")
        ends.select(
            "capture_instance", F.col("max_lsn").alias("last_lsn"), (F.coalesce("numbered", F.lit(0)) + F.col("added")).alias("numbered")
        ).write.mode("overwrite").parquet(f"{self.path}/ends/batch={batch}")
        return written.drop("number")

    def plan(self) -> DataFrame:
        """The window of every position numbered so far."""
        schema = "capture_instance string, start_lsn string, window_id bigint"
        return self.spark.read.schema(schema).parquet(f"{self.path}/plan").drop("batch")


def sized_plan(rows: DataFrame, size: int = WINDOW_SIZE) -> DataFrame:
    """WN1 with the change rows of every transaction, in ``rows``."""
    sizes = rows.groupBy("capture_instance", "start_lsn").agg(F.count(F.lit(1)).alias("rows"))
    numbered = number_rows(sizes, ["capture_instance"], ["start_lsn"], "__n", unique=True)
    window = F.call_function("div", F.col("__n") - 1, F.lit(size).cast("bigint"))
    return numbered.select("capture_instance", "start_lsn", "rows", window.alias("window_id"))


def file_parts(sized: DataFrame, rows_per_file: int, tasks: int) -> tuple[DataFrame, int, bool]:
    """AG4: the writing task of every transaction, from the counts of a ``sized_plan``.

    Returns the plan with ``part`` and ``large``, the number of parts, and whether a window is ``large``. The transactions of a
    window fill its files one after the other, so the parts of a window ascend with its positions; windows begin at hashed parts.
    A window in which one transaction alone is more than a file is ``large``: its positions don't tell where to cut.
    """
    window = W.partitionBy("capture_instance", "window_id")
    before = F.sum("rows").over(window.orderBy("start_lsn").rowsBetween(W.unboundedPreceding, -1))
    of_window = window.orderBy("start_lsn").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    placed = sized.select(
        "capture_instance",
        "start_lsn",
        "rows",
        "window_id",
        F.call_function("div", F.coalesce(before, F.lit(0)), F.lit(rows_per_file).cast("bigint")).alias("__file"),
        (F.max("rows").over(of_window) > rows_per_file).alias("large"),
    )
    usual = F.when(~F.col("large"), F.col("__file"))
    # One row.
    total, files, windows, large = placed.agg(
        F.sum("rows"), F.max(usual), F.countDistinct("capture_instance", "window_id"), F.max("large")
    ).first()
    starts = max(-(-(total or 0) // rows_per_file), min(windows, tasks), 1)
    parts = starts + (files or 0)
    part = F.pmod(F.xxhash64("capture_instance", "window_id"), F.lit(starts)) + F.least("__file", F.lit(files or 0))
    return placed.select("capture_instance", "start_lsn", "window_id", "large", part.cast("int").alias("part")), parts, bool(large)


def window_bounds(plan: DataFrame, starts: DataFrame) -> DataFrame:
    """WN2: the first window begins at the resume position, each further one right after the one before.

    ``starts`` has one row per table: ``capture_instance``, ``resume_lsn``. The neighbour comes from an
    equi-join on the window number, so a table with very many windows is not sorted by one task.
    """
    ends = lsn_extent(plan, ["capture_instance", "window_id"], transactions=F.lit(1).cast("bigint"))
    ends = ends.withColumnRenamed("max_lsn", "to_lsn")
    before = ends.select(
        "capture_instance", (F.col("window_id") + 1).alias("window_id"), following(F.col("to_lsn")).alias("__next")
    )
    return (
        ends.join(before, ["capture_instance", "window_id"], "left")
        .join(starts, "capture_instance", "left")
        .select(
            "capture_instance",
            "window_id",
            F.when(F.col("window_id") == 0, F.col("resume_lsn")).otherwise(F.col("__next")).alias("from_lsn"),
            "to_lsn",
            "transactions",
        )
    )


def next_window_end(rows: DataFrame, low: str, high: str, size: int) -> DataFrame:
    """AG3, SO4: the last of the first ``size`` transactions in a range of one table; null if none."""
    first = (
        rows.where(F.col("start_lsn").between(low, high)).select("start_lsn").distinct().orderBy("start_lsn").limit(size)
    )
    return first.agg(F.max("start_lsn").alias("window_end_lsn"))


def window_counts(events: DataFrame, plan: DataFrame) -> DataFrame:
    """AG4, JN8: events per window; events are counted per transaction before they meet the plan."""
    return window_totals(events.groupBy("capture_instance", "start_lsn").agg(F.count(F.lit(1)).alias("events")), plan)


def window_totals(per_transaction: DataFrame, plan: DataFrame) -> DataFrame:
    """AG4, JN8: the same from the number of ``events`` of every transaction; a window without events has no row."""
    return (
        per_transaction.where("events > 0")
        .join(plan, ["capture_instance", "start_lsn"])
        .groupBy("capture_instance", "window_id")
        .agg(F.sum("events").alias("records"))
    )


def run_totals(counts: DataFrame) -> DataFrame:
    """AG5: files and records of a run. A window without events has no row, hence no file."""
    return counts.agg(
        F.count(F.lit(1)).alias("files_written"), F.coalesce(F.sum("records"), F.lit(0)).alias("total_records")
    )
