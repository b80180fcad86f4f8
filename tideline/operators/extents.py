"""Lowest and highest log position per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.lsn import hex_digits

_PREFIX, _REST = 12, 8


def lsn_extent(rows: DataFrame, keys: Sequence[str], **sums: Column) -> DataFrame:
    """``min_lsn`` and ``max_lsn`` per group, plus named columns to be summed up.

    A text minimum cannot be kept in a hash aggregate: Spark would sort all rows by group on the map side.
    So positions are split: the leading digits join the group, the rest is compared as a number. That leaves
    a handful of rows per group and file, and only those are compared as text.
    """
    keys = list(keys)
    rest = F.conv(F.substring("start_lsn", _PREFIX + 1, _REST), 16, 10).cast("bigint")
    parts = rows.groupBy(*keys, F.substring("start_lsn", 1, _PREFIX).alias("__prefix")).agg(
        F.min(rest).alias("__low"), F.max(rest).alias("__high"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )

    def text(number: str) -> Column:
        return F.concat("__prefix", hex_digits(F.col(number), _REST))

    return parts.groupBy(*keys).agg(
        F.min(text("__low")).alias("min_lsn"),
        F.max(text("__high")).alias("max_lsn"),
        *[F.sum(n).alias(n) for n in sums],
    )
