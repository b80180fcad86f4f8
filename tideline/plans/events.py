"""The change stream of one or many tables, from raw change rows to JSON lines."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.json_values import extend_object, json_line
from tideline.model import CapturedTable, Origin
from tideline.operators import changes, envelope
from tideline.operators.skew import GROUP_ROWS_PER_TASK
from tideline.sources.change_tables import LANDED_COLUMNS, ChangeSource, landed_all


def with_commit_time(rows: DataFrame, lsn_time: DataFrame) -> DataFrame:
    """JN1: commit time of every transaction, null if unknown.

    One transaction may hold a large share of the rows. The join is left to Spark, which broadcasts the
    time table if its size allows and otherwise splits the skewed side at run time; it comes after the
    pairing, so its partitioning serves no later step and may be split.
    """
    return rows.join(commit_times(lsn_time), "start_lsn", "left")


def commit_times(lsn_time: DataFrame) -> DataFrame:
    """One row per transaction, also if the log was landed more than once: the earliest time it names.

    The rebalance keeps the exchange of this aggregate apart from that of a join above, which Spark can only
    split where a transaction is large if nothing else relies on it. It moves the narrow log once more.
    """
    return lsn_time.groupBy("start_lsn").agg(F.min("commit_time").alias("commit_time")).hint("rebalance")


def change_events(
    rows: DataFrame,
    table: CapturedTable,
    origin: Origin,
    processed_at: datetime,
    lsn_time: DataFrame | None = None,
    strict: bool = True,
    hot_rows: int = GROUP_ROWS_PER_TASK,
) -> DataFrame:
    """CP10 + EN1: flat events of one captured table with typed columns and their order columns."""
    found = changes.classify(rows, table.primary_key, table.has_command_id, hot_rows)
    kept = changes.events(found, strict)
    if lsn_time is not None:
        kept = with_commit_time(kept, lsn_time)
    return envelope.flat_events(kept, table, origin, processed_at)


def paired_lines(
    sources: Iterable[ChangeSource],
    strict: bool = True,
    hot_rows: int = GROUP_ROWS_PER_TASK,
    before: bool = False,
) -> DataFrame:
    """MS1: events of many tables of any shape in one job, with key and image as JSON objects.

    Every table is brought into one form where it is scanned; then all of them are one DataFrame keyed by
    ``capture_instance``, with one exchange and one window however many tables there are.
    """
    return paired_landed(landed_all(sources, before_images=before), strict, hot_rows, before)


def paired_landed(
    rows: DataFrame, strict: bool = True, hot_rows: int = GROUP_ROWS_PER_TASK, before: bool = False
) -> DataFrame:
    """MS1: the same for change rows of many tables that are one DataFrame already (``LANDED_COLUMNS``).

    Rows of a change with equal operations are ordered by the text of their key, then by a hash of the image. With
    ``before`` each event also has the image that it replaced or deleted.
    """
    keyed = changes.with_change_key(rows.select(*LANDED_COLUMNS))
    kept = changes.events(changes.classify_known(keyed, ("key",), changes.find_hot(keyed, hot_rows), before), strict)
    columns = ["capture_instance", *envelope.ORDER, "__op", "key", "image"]
    if before:
        replaced = F.when(F.col("__op") == "u", F.col("previous.image")).when(F.col("__op") == "d", F.col("image"))
        columns.append(replaced.alias("before"))
    return kept.select(*columns)


def event_lines(
    events: DataFrame, origin: Origin, processed_at: datetime, tombstones: bool, key_schemas: bool, full: bool = False
) -> DataFrame:
    """SK1: the text of every event and tombstone, in ``value``.

    ``events`` comes from ``paired_lines`` together with ``source_schema``, ``source_table``, ``key_schema`` and, if
    known, ``commit_time``. ``full`` writes whole envelopes (EN4) and needs the ``before`` images.
    """
    if full:
        after = F.when(F.col("__op") != "d", F.col("image"))
        event = envelope.full_line(events, origin, processed_at, F.col("before"), after)
    else:
        fields = json_line(
            [
                F.col("__op"),
                F.col("source_table").alias("__table"),
                envelope.deleted_flag().alias("__deleted"),
                envelope.source_ts_ms(events, origin, processed_at).alias("__source_ts_ms"),
            ]
        )
        event = extend_object(F.col("image"), fields)
    if not tombstones:
        return events.select("*", F.lit(False).alias("tombstone"), event.alias("value"))
    grave = envelope.tombstone_line(F.col("key"), F.col("key_schema") if key_schemas else None)
    both = envelope.with_tombstones(events)
    return both.withColumn("value", F.when(F.col("tombstone"), grave).otherwise(event))
