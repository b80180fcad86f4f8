"""SK4, SK5, ST3, ST4: names of folders and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.lsn import to_text


def topic_folder(topic_prefix: Column, database: Column, schema: Column, table: Column) -> Column:
    """ST3."""
    return F.concat_ws(".", topic_prefix, database, schema, table)


def join_path(*parts: Column) -> Column:
    """ST4: strip slashes from every part, skip empty and null parts."""
    stripped = F.transform(F.array(*parts), lambda p: F.regexp_replace(p, "^/+|/+$", ""))
    return F.array_join(F.filter(stripped, lambda p: p.isNotNull() & (p != "")), "/")


def date_folders(started_at: Column) -> list[Column]:
    """SK4: the optional date levels of a path."""
    levels = {"year": "yyyy", "month": "MM", "day": "dd"}
    return [F.concat(F.lit(f"{n}="), F.date_format(started_at, f)) for n, f in levels.items()]


def window_label(from_lsn: Column, to_lsn: Column, run_id: Column) -> Column:
    """SK5."""
    return F.concat_ws("_", to_text(from_lsn), to_text(to_lsn), run_id)
