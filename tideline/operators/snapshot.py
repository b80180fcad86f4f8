"""Full reads of a captured table as events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.model import CapturedTable, Origin
from tideline.operators.envelope import check_reserved, full_line, image_text, to_epoch_ms
from tideline.operators.skew import number_rows


def snapshot_scan(source: DataFrame, table: CapturedTable) -> DataFrame:
    """SC2: captured columns in ordinal order."""
    return source.select(*table.column_names)


def snapshot_events(
    source: DataFrame, table: CapturedTable, processed_at: datetime, min_lsn: str
) -> DataFrame:
    """EN8: one ``r`` event per row; no commit time, positions are the low watermark. Map-only."""
    check_reserved(table)
    return snapshot_scan(source, table).select(
        F.lit(table.capture_instance).alias("capture_instance"),
        F.lit(min_lsn).alias("start_lsn"),
        *table.column_names,
        F.lit("r").alias("__op"),
        F.lit(table.source_table).alias("__table"),
        F.lit("false").alias("__deleted"),
        F.lit(to_epoch_ms(processed_at)).cast("bigint").alias("__source_ts_ms"),
    )


def snapshot_serials(source: DataFrame, table: CapturedTable) -> DataFrame:
    """WN5: number the rows of a table in key order, across all tasks.

    A table without a key is numbered by a hash of its columns; only there rows can be equal.
    """
    scan = snapshot_scan(source, table)
    if table.primary_key:
        return number_rows(scan, [], table.primary_key, "serial", unique=True)
    tied = scan.withColumn("__tie", F.xxhash64(*table.column_names))
    return number_rows(tied, [], ["__tie"], "serial").drop("__tie")


def snapshot_envelopes(
    source: DataFrame, table: CapturedTable, origin: Origin, processed_at: datetime, min_lsn: str
) -> DataFrame:
    """EN4, EN8, WN5: whole envelopes of a full read as JSON lines, in ``value``, beside their order columns.

    Both positions of the source block are the low watermark, and the serial numbers the rows in key order.
    """
    check_reserved(table)
    rows = snapshot_serials(source, table)
    image = image_text(rows, table)
    rows = rows.select(
        F.lit(table.capture_instance).alias("capture_instance"),
        F.lit(table.source_schema).alias("source_schema"),
        F.lit(table.source_table).alias("source_table"),
        F.lit(min_lsn).alias("start_lsn"),
        F.lit(min_lsn).alias("seqval"),
        "serial",
        image.alias("image"),
    )
    line = full_line(rows, origin, processed_at, F.lit(None).cast("string"), F.col("image"), F.lit("r"))
    return rows.select("capture_instance", "start_lsn", "serial", line.alias("value"))


def snapshot_plus_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """ST2: both kinds of events of one table in one table."""
    shared = [c for c in snapshot.columns if c in changes.columns]
    return snapshot.select(*shared).unionByName(changes.select(*shared))
