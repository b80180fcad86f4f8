"""Reading landed change tables, and bringing tables of different shape into one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.lsn import from_binary
from tideline.model import BEFORE_UPDATE, SYSTEM_COLUMNS, CapturedTable, Origin
from tideline.operators.envelope import check_reserved, image_text, key_schema_text, key_text

# System columns as a change table of the source names them.
RAW_NAMES = {
    "__$start_lsn": "start_lsn",
    "__$seqval": "seqval",
    "__$operation": "operation",
    "__$command_id": "command_id",
    "__$commit_time": "commit_time",
}
_UNUSED_RAW = ("__$end_lsn", "__$update_mask")

# What ``landed`` returns for every captured table, whatever its columns are.
LANDED_COLUMNS = (*SYSTEM_COLUMNS, "key", "image")


@dataclass(frozen=True)
class ChangeSource:
    """One captured table with its change rows and, for snapshots, its current rows.

    ``changes`` may still have the source's own names and binary positions (see ``from_raw``).
    """

    table: CapturedTable
    changes: DataFrame
    current: DataFrame | None = None


@dataclass(frozen=True)
class LandedLog:
    """Change rows of any number of captured tables as one DataFrame (``LANDED_COLUMNS``), keyed by ``capture_instance``.

    A run over it has a plan of the same size however many tables there are. ``catalog`` (see ``capture_catalog``) spares
    a scan where it is kept beside the rows; ``current`` has the current rows of tables that may need a snapshot.
    """

    tables: tuple[CapturedTable, ...]
    rows: DataFrame
    current: Mapping[str, DataFrame] = field(default_factory=dict)
    catalog: DataFrame | None = None


def from_raw(rows: DataFrame, capture_instance: str) -> DataFrame:
    """Change rows as the source stores them (binary positions, ``__$`` names) in this package's form."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    out = []
    for name in rows.columns:
        if name in _UNUSED_RAW:
            continue
        value = F.col(f"`{name}`")
        if name in ("__$start_lsn", "__$seqval") and isinstance(types[name], T.BinaryType):
            value = from_binary(value)
        elif name in ("__$operation", "__$command_id"):
            value = value.cast("int")
        out.append(value.alias(RAW_NAMES.get(name, name)))
    return rows.select(F.lit(capture_instance).alias("capture_instance"), *out)


def change_rows(source: ChangeSource, low: str, high: str) -> DataFrame:
    """SC1: change rows of a range. Raw rows are filtered on their binary column, so the scan prunes them too."""
    rows = source.changes
    if "__$start_lsn" not in rows.columns:
        return rows.where(F.col("start_lsn").between(low, high))
    position = F.col("`__$start_lsn`")
    ranged = rows.where(position.between(F.lit(bytearray.fromhex(low)), F.lit(bytearray.fromhex(high))))
    return from_raw(ranged, source.table.capture_instance)


def read_changes(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """SC1: landed change rows; range filters and column choices reach this scan."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, bounds: dict | None = None, **options: str) -> DataFrame:
    """SC1, SC2 over JDBC. ``bounds`` (column, lower, upper, partitions) splits the read into parallel queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if bounds:
        reader = (
            reader.option("partitionColumn", bounds["column"])
            .option("lowerBound", bounds["lower"])
            .option("upperBound", bounds["upper"])
            .option("numPartitions", bounds["partitions"])
        )
    return reader.load()


def landed(source: ChangeSource, before_images: bool = True) -> DataFrame:
    """Change rows of one table with key and image as JSON objects, ready to be united with other tables.

    Without ``before_images`` the image of an update's first half, which flat events never show, is left out.
    """
    check_reserved(source.table)
    rows = source.changes
    has_command = source.table.has_command_id and "command_id" in rows.columns
    command = F.col("command_id") if has_command else F.lit(None)
    image = image_text(rows, source.table)
    if not before_images:
        image = F.when(~F.col("operation").eqNullSafe(BEFORE_UPDATE), image)
    return rows.select(
        F.lit(source.table.capture_instance).alias("capture_instance"),
        "start_lsn",
        "seqval",
        command.cast("int").alias("command_id"),
        "operation",
        key_text(rows, source.table).alias("key"),
        image.alias("image"),
    )


def landed_all(sources: Iterable[ChangeSource], before_images: bool = True) -> DataFrame:
    """MS1: all captured tables of a source as one table keyed by ``capture_instance``.

    Each table adds its scan and one projection; whatever follows is one plan for all of them.
    """
    return reduce(DataFrame.unionByName, [landed(s, before_images) for s in sources])


def table_facts(spark: SparkSession, tables: Sequence[CapturedTable], origin: Origin) -> DataFrame:
    """One row per captured table (the caller lists them): names, topic and key schema document."""
    rows = [
        (t.capture_instance, t.source_schema, t.source_table, origin.topic(t), key_schema_text(t, origin), t.has_command_id)
        for t in tables
    ]
    return spark.createDataFrame(
        rows,
        "capture_instance string, source_schema string, source_table string, topic string, key_schema string, "
        "has_command_id boolean",
    )
