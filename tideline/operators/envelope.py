"""Event shapes: flat events, full envelopes, tombstones and their JSON lines."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.errors import ReservedColumn
from tideline.functions import lsn, times
from tideline.functions.json_values import json_columns, json_line
from tideline.model import EVENT_FIELDS, WORKING_COLUMNS, CapturedTable, ColumnInfo, Origin

# Columns that carry the order of events until they are written.
ORDER = ("start_lsn", "command_key", "seqval", "serial")

# Declared event type of a source type; every other type is "string".
DECLARED_TYPES = {
    "bigint": "int64",
    "int": "int32",
    "smallint": "int16",
    "tinyint": "int16",
    "bit": "boolean",
    "real": "float",
    "float": "double",
}

# Constants of the source block.
SOURCE_VERSION = "3.0.0.Final-simulated"
SOURCE_CONNECTOR = "sqlserver"


def to_epoch_ms(moment: datetime) -> int:
    """A processing time given by the caller; without a zone it is UTC."""
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    whole = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (whole.days * 86_400 + whole.seconds) * 1_000 + whole.microseconds // 1_000


def source_ts_ms(rows: DataFrame, origin: Origin, processed_at: datetime) -> Column:
    """EN2: commit time, else processing time. Only a zone-less commit time is read in the source zone."""
    processed = F.lit(to_epoch_ms(processed_at)).cast("bigint")
    if "commit_time" not in rows.columns:
        return processed
    zoned = isinstance(rows.schema["commit_time"].dataType, T.TimestampType)
    commit = F.col("commit_time")
    known = times.instant_ms(commit) if zoned else times.epoch_ms(commit, origin.timezone)
    return F.coalesce(known, processed)


def check_reserved(table: CapturedTable) -> None:
    taken = [c for c in table.column_names if c in EVENT_FIELDS or c in WORKING_COLUMNS or c.startswith("__")]
    if taken:
        raise ReservedColumn(f"{table.capture_instance} captures reserved columns: {', '.join(taken)}")


def flat_events(events: DataFrame, table: CapturedTable, origin: Origin, processed_at: datetime) -> DataFrame:
    """EN1, PF9: the surviving image plus the four metadata fields, next to the order columns."""
    check_reserved(table)
    return events.select(
        "capture_instance",
        *ORDER,
        *table.column_names,
        "__op",
        F.lit(table.source_table).alias("__table"),
        deleted_flag().alias("__deleted"),
        source_ts_ms(events, origin, processed_at).alias("__source_ts_ms"),
    )


def deleted_flag() -> Column:
    """The flag is text in events."""
    return F.when(F.col("__op") == "d", "true").otherwise("false")


def with_tombstones(events: DataFrame) -> DataFrame:
    """CP9: a second row right after every delete, told apart by ``tombstone``. No shuffle."""
    marks = F.when(F.col("__op") == "d", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return events.withColumn("tombstone", F.explode(marks))


def key_struct(table: CapturedTable) -> Column:
    """PF7: the primary key, or null for a table without one."""
    return F.struct(*table.primary_key) if table.primary_key else F.lit(None).cast("struct<none:string>")


def schema_name(table: CapturedTable, origin: Origin, suffix: str) -> str:
    """EN7: the schema comes before the database here."""
    return ".".join((origin.topic_prefix, table.source_schema, origin.database, table.source_table, suffix))


def field_schema(column: ColumnInfo, optional: bool) -> dict:
    """EN9: declared type and parameters of one field."""
    parameters = {"sqlserver_type": column.sql_type}
    for name, value in (
        ("numeric_precision", column.precision),
        ("numeric_scale", column.scale),
        ("character_maximum_length", column.max_length),
    ):
        if value is not None:
            parameters[name] = str(value)
    declared = DECLARED_TYPES.get(column.sql_type.lower(), "string")
    return {"field": column.name, "type": declared, "optional": optional, "parameters": parameters}


def key_schema(table: CapturedTable, origin: Origin) -> dict:
    """EN5: schema document of the key; an empty struct for a table without one."""
    fields = [field_schema(c, optional=False) for c in table.columns if c.name in table.primary_key]
    name = schema_name(table, origin, "Key")
    return {"type": "struct", "fields": fields, "optional": not fields, "name": name, "version": 1}


def key_schema_text(table: CapturedTable, origin: Origin) -> str:
    return json.dumps(key_schema(table, origin), ensure_ascii=False)


def image_text(rows: DataFrame, table: CapturedTable) -> Column:
    """The captured columns as one JSON object."""
    return json_line(json_columns(rows, table))


def key_text(rows: DataFrame, table: CapturedTable) -> Column:
    """The key columns as one JSON object in key order; null for a table without a key."""
    if not table.primary_key:
        return F.lit(None).cast("string")
    by_name = dict(zip(table.column_names, json_columns(rows, table), strict=True))
    return json_line([by_name[k] for k in table.primary_key])


def tombstone_line(key: Column, schema: Column | None = None) -> Column:
    """EN3: ``{"key": …, "value": null}``; with ``schema`` the key is wrapped together with its document."""
    wrapped = key if schema is None else F.concat(F.lit('{"schema":'), schema, F.lit(',"payload":'), key, F.lit("}"))
    return F.concat(F.lit('{"key":'), F.coalesce(wrapped, F.lit("null")), F.lit(',"value":null}'))


def source_fields(events: DataFrame, origin: Origin, source_schema: Column, source_table: Column) -> list[Column]:
    """EN4: the fields of the source block; the times are null where the commit time is unknown."""
    zoned = "commit_time" in events.columns and isinstance(events.schema["commit_time"].dataType, T.TimestampType)
    if "commit_time" not in events.columns:
        micros = F.lit(None).cast("bigint")
    elif zoned:
        micros = F.unix_micros("commit_time")
    else:
        micros = times.epoch_us(F.col("commit_time"), origin.timezone)
    return [
        F.lit(SOURCE_VERSION).alias("version"),
        F.lit(SOURCE_CONNECTOR).alias("connector"),
        F.lit(origin.topic_prefix).alias("name"),
        F.call_function("div", micros, F.lit(1000).cast("bigint")).alias("ts_ms"),
        micros.alias("ts_us"),
        (micros * 1000).alias("ts_ns"),
        F.lit(False).alias("snapshot"),
        F.lit(origin.database).alias("db"),
        source_schema.alias("schema"),
        source_table.alias("table"),
        lsn.to_colon_text(F.col("seqval")).alias("change_lsn"),
        lsn.to_colon_text(F.col("start_lsn")).alias("commit_lsn"),
        F.col("serial").cast("string").alias("event_serial_no"),
    ]


def processed_fields(processed_at: datetime) -> list[Column]:
    """EN4: when an event was made, in three units."""
    now = to_epoch_ms(processed_at)
    units = (("ts_ms", 1), ("ts_us", 1_000), ("ts_ns", 1_000_000))
    return [F.lit(now * unit).cast("bigint").alias(name) for name, unit in units]


def full_line(
    events: DataFrame, origin: Origin, processed_at: datetime, before: Column, after: Column, op: Column | None = None
) -> Column:
    """EN4, EN8: the whole envelope as one JSON object, from images that are JSON objects or null.

    ``events`` has the order columns, ``source_schema``, ``source_table`` and, if known, ``commit_time``.
    """
    source = json_line(source_fields(events, origin, F.col("source_schema"), F.col("source_table")))
    rest = json_line([(F.col("__op") if op is None else op).alias("op"), *processed_fields(processed_at)])
    none = F.lit("null")
    return F.concat(
        F.lit('{"before":'),
        F.coalesce(before, none),
        F.lit(',"after":'),
        F.coalesce(after, none),
        F.lit(',"source":'),
        source,
        F.lit(","),
        F.substring(rest, 2, 2**31 - 1),
    )


def full_envelopes(events: DataFrame, table: CapturedTable, origin: Origin, processed_at: datetime) -> DataFrame:
    """EN4: ``before``, ``after``, ``source`` and times. ``events`` must come with ``previous`` images."""
    image = F.struct(*table.column_names)
    op = F.col("__op")
    source = F.struct(*source_fields(events, origin, F.lit(table.source_schema), F.lit(table.source_table)))
    previous = F.struct(*[F.col(f"previous.{c}").alias(c) for c in table.column_names])
    return events.select(
        "capture_instance",
        *ORDER,
        F.when(op == "u", previous).when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        source.alias("source"),
        op.alias("op"),
        *processed_fields(processed_at),
    )
