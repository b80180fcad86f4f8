"""Names and small descriptions shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Operation codes of a change row.
DELETE, INSERT, BEFORE_UPDATE, AFTER_UPDATE = 1, 2, 3, 4

# Columns every change row carries besides its captured columns.
SYSTEM_COLUMNS = ("capture_instance", "start_lsn", "seqval", "command_id", "operation")

# One logical change: all rows that agree on these columns.
CHANGE_KEY = ("capture_instance", "start_lsn", "command_key", "seqval")

# Columns that the operators add to change rows beside the captured ones; a captured column of that name is refused.
WORKING_COLUMNS = (*SYSTEM_COLUMNS, "command_key", "commit_time", "serial", "kind", "has_update_half", "previous")

# Metadata fields of a flat event.
EVENT_FIELDS = ("__op", "__table", "__deleted", "__source_ts_ms")


@dataclass(frozen=True)
class ColumnInfo:
    """One captured column as the source database declares it."""

    name: str
    sql_type: str
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True


@dataclass(frozen=True)
class CapturedTable:
    """What is known about one captured table; columns are listed in ordinal order."""

    capture_instance: str
    source_schema: str
    source_table: str
    columns: tuple[ColumnInfo, ...]
    primary_key: tuple[str, ...] = ()
    has_command_id: bool = True

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @classmethod
    def of(
        cls,
        capture_instance: str,
        rows: DataFrame,
        primary_key: tuple[str, ...] = (),
        source_schema: str = "dbo",
        source_table: str | None = None,
        has_command_id: bool = True,
    ) -> CapturedTable:
        """Describe a table from the schema of its change rows, in either form (or of the table itself)."""
        own = (*SYSTEM_COLUMNS, "commit_time")
        captured = [f for f in rows.schema.fields if f.name not in own and not f.name.startswith("__$")]
        return cls(
            capture_instance=capture_instance,
            source_schema=source_schema,
            source_table=source_table or capture_instance.split("_", 1)[-1],
            columns=tuple(_column_info(f) for f in captured),
            primary_key=tuple(primary_key),
            has_command_id=has_command_id,
        )


@dataclass(frozen=True)
class Origin:
    """Where events come from; names the output folder and fills the source block."""

    topic_prefix: str
    database: str
    timezone: str = "UTC"

    def topic(self, table: CapturedTable) -> str:
        return ".".join((self.topic_prefix, self.database, table.source_schema, table.source_table))


def _column_info(field: T.StructField) -> ColumnInfo:
    data_type = field.dataType
    name = _SQL_TYPE_OF.get(type(data_type), "nvarchar")
    if isinstance(data_type, T.DecimalType):
        return ColumnInfo(field.name, "decimal", None, data_type.precision, data_type.scale, field.nullable)
    return ColumnInfo(field.name, name, nullable=field.nullable)


_SQL_TYPE_OF = {
    T.LongType: "bigint",
    T.IntegerType: "int",
    T.ShortType: "smallint",
    T.BooleanType: "bit",
    T.FloatType: "real",
    T.DoubleType: "float",
    T.DateType: "date",
    T.TimestampNTZType: "datetime2",
    T.TimestampType: "datetimeoffset",
    T.BinaryType: "varbinary",
}
