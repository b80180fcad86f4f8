"""JS1, JS2: captured values as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.model import CapturedTable

_KEEP_NULLS = {"ignoreNullFields": "false"}


def json_value(name: str, data_type: T.DataType, sql_type: str = "") -> Column:
    """The value as it appears in an event: exact decimals, ISO times and base64 bytes as text."""
    value = F.col(f"`{name}`")
    if isinstance(data_type, T.DecimalType):
        return _plain_decimal(value, data_type.scale)
    if isinstance(data_type, T.DateType):
        return F.date_format(value, "yyyy-MM-dd")
    if isinstance(data_type, T.TimestampNTZType):
        return _iso(value)
    if isinstance(data_type, T.TimestampType):
        utc = F.convert_timezone(None, F.lit("UTC"), value.cast("timestamp_ntz"))
        return F.concat(_iso(utc), F.lit("+00:00"))
    if isinstance(data_type, T.BinaryType):
        return F.translate(F.base64(value), "\r\n", "")
    if sql_type.lower() == "uniqueidentifier":
        return F.lower(value)
    return value


def json_columns(rows: DataFrame, table: CapturedTable) -> list[Column]:
    """PF1 + JS1: captured columns in ordinal order, each in its event form."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    return [json_value(c.name, types[c.name], c.sql_type).alias(c.name) for c in table.columns]


def json_line(columns: list[Column]) -> Column:
    """JS2: one JSON object; nulls are written out, text stays as it is."""
    return F.to_json(F.struct(*columns), _KEEP_NULLS)


def extend_object(text: Column, extra: Column) -> Column:
    """Append the fields of JSON object ``extra`` to JSON object ``text`` (neither may be empty)."""
    opened = F.substring(text, F.lit(1), F.length(text) - 1)
    # Up to the end, whatever its length: ``extra`` is worked out once, also where it stands in a branch.
    fields = F.substring(extra, 2, 2**31 - 1)
    return F.concat(opened, F.lit(","), fields)


def _plain_decimal(value: Column, scale: int) -> Column:
    """Decimal text without an exponent, also where ANSI mode is off (it then shows tiny values as ``1.0E-7``)."""
    text = value.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, "^-?([0-9.]+)E", 1), r"\.", "")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    plain = F.concat(sign, F.lit("0."), F.lpad(digits, scale, "0"))
    return F.when(text.contains("E"), plain).otherwise(text)


def _iso(wall: Column) -> Column:
    fraction = F.when(F.date_format(wall, "SSSSSS") == "000000", "").otherwise(F.date_format(wall, ".SSSSSS"))
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"), fraction)
