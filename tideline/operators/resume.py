"""Where each table resumes, and what its next bookmark is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.errors import LogGap, MissingPosition
from tideline.functions.lsn import LOWEST, following, to_text
from tideline.operators.extents import lsn_extent
from tideline.session import small_side

SNAPSHOT_MODES = ("initial", "always", "never")


def run_ceiling(positions: DataFrame) -> DataFrame:
    """SC7: the highest log position known now."""
    return positions.agg(F.max("start_lsn").alias("max_lsn"))


def freeze_ceiling(positions: DataFrame) -> str:
    """RS5: the ceiling as one value for the whole run; a run without one must not start."""
    ceiling = run_ceiling(positions).first()["max_lsn"]
    if not ceiling:
        raise MissingPosition("the source has no log position yet")
    return ceiling


def low_watermarks(rows: DataFrame) -> DataFrame:
    """SC8: oldest retained position per table."""
    return lsn_extent(rows, ["capture_instance"]).select("capture_instance", "min_lsn")


def check_low_watermarks(watermarks: DataFrame, tables: Sequence[str] | None = None) -> None:
    """SC8: an absent or all-zero low watermark means capture is not ready.

    With ``tables`` (the tables of a run, listed by its caller) a table without a row is refused, too.
    """
    known = watermarks.select("capture_instance", "min_lsn")
    if tables is not None:
        # One row per captured table.
        wanted = watermarks.sparkSession.createDataFrame([(t,) for t in tables], "capture_instance string")
        known = wanted.join(known, "capture_instance", "left")
    bad = known.where(F.col("min_lsn").isNull() | (F.col("min_lsn") == LOWEST)).orderBy("capture_instance").limit(21).collect()
    if bad:
        listed = ", ".join(r["capture_instance"] for r in bad[:20])
        raise MissingPosition(f"no low watermark for: {listed}" + (" and more" if len(bad) > 20 else ""))


def resume_plan(
    watermarks: DataFrame, bookmarks: DataFrame, ceiling: str, snapshot_mode: str = "initial"
) -> DataFrame:
    """RS1-RS4, RS6, JN4: one row per table with its resume position and what to do.

    No bookmark: start at the low watermark. A bookmark below it is a gap and restarts there. Otherwise
    start right after the bookmark. The next bookmark is the ceiling, but never moves back.
    """
    saved, low = F.col("lsn"), F.col("min_lsn")
    gap = F.coalesce(saved < low, F.lit(False))
    resume = F.when(saved.isNull() | gap, low).otherwise(following(saved))
    if snapshot_mode not in SNAPSHOT_MODES:
        raise ValueError(f"unknown snapshot mode {snapshot_mode!r}")
    snapshot = {"always": F.lit(True), "never": F.lit(False)}.get(snapshot_mode, saved.isNull())
    return (
        watermarks.select("capture_instance", "min_lsn")
        .join(bookmarks.select("capture_instance", "lsn"), "capture_instance", "left")
        .select(
            "capture_instance",
            "min_lsn",
            saved.alias("bookmark_lsn"),
            resume.alias("resume_lsn"),
            gap.alias("has_gap"),
            (resume > ceiling).alias("is_done"),
            snapshot.alias("take_snapshot"),
            F.greatest(saved, F.lit(ceiling)).alias("next_lsn"),
        )
    )


def lsn_gaps(plan: DataFrame) -> DataFrame:
    """RS2: tables whose bookmark is older than what the source still holds."""
    return plan.where("has_gap").select("capture_instance", "bookmark_lsn", "min_lsn")


def require_no_gaps(plan: DataFrame) -> None:
    """RS2, strict: refuse to run before anything is written."""
    gaps = lsn_gaps(plan).limit(20).collect()
    if gaps:
        listed = ", ".join(f"{g['capture_instance']} ({g['bookmark_lsn']} < {g['min_lsn']})" for g in gaps)
        raise LogGap(f"changes were removed before they were read: {listed}")


def merge_bookmarks(old: DataFrame, new: DataFrame) -> DataFrame:
    """JN5: new positions win; tables that were not part of the run keep theirs."""
    fresh = new.select("capture_instance", F.col("lsn").alias("__new"))
    return old.join(fresh, "capture_instance", "full_outer").select(
        "capture_instance", F.coalesce("__new", "lsn").alias("lsn")
    )


def next_bookmarks(plan: DataFrame) -> DataFrame:
    """RS6: the bookmark of every planned table after the run, changed or not."""
    return plan.select("capture_instance", F.col("next_lsn").alias("lsn"))


def bookmark_text(bookmarks: DataFrame) -> DataFrame:
    """Bookmarks in the stored form."""
    return bookmarks.select("capture_instance", to_text(F.col("lsn")).alias("lsn"))


def late_rows(arrived: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """SS5: newly arrived rows at or below the bookmark; an incremental run will never read them."""
    marks = small_side(bookmarks.select("capture_instance", "lsn"), "bookmarks")  # one row per table
    return arrived.join(marks, "capture_instance").where(F.col("start_lsn") <= F.col("lsn")).drop("lsn")
