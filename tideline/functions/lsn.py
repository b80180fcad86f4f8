"""Log positions (LSN) as Spark columns.

A position is ten bytes. Everywhere in this package it is a 20-character upper-case hex string: text order
equals byte order, so comparisons, ranges and sorts work on the plain column and reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 20
LOWEST = "0" * DIGITS
HIGHEST = "F" * DIGITS


def from_binary(value: Column) -> Column:
    """Ten raw bytes to the canonical form (upper-case hex)."""
    return F.hex(value)


def hex_digits(number: Column, size: int) -> Column:
    """A whole number as upper-case hex of fixed width."""
    return F.lpad(F.hex(number), size, "0")


def to_text(lsn: Column) -> Column:
    """LN1: the ``0x…`` form used in bookmarks, labels and manifests."""
    return F.concat(F.lit("0x"), F.upper(lsn))


def parse(text: Column) -> Column:
    """LN2: read hex with or without ``0x``; odd or non-hex text fails the job."""
    digits = F.trim(F.regexp_replace(text, "^0[xX]", ""))
    return F.when(digits.rlike("^([0-9A-Fa-f]{2})*$"), F.upper(digits)).when(
        text.isNotNull(), F.raise_error(F.concat(F.lit("not a hex log position: "), text))
    )


def to_binary(text: Column) -> Column:
    """LN2 as bytes."""
    return F.unhex(parse(text))


def to_colon_text(lsn: Column) -> Column:
    """LN3: the ``8:8:4`` form; any other length than ten bytes fails the job."""
    digits = F.upper(lsn)
    return F.when(
        F.length(digits) == DIGITS,
        F.concat_ws(":", F.substring(digits, 1, 8), F.substring(digits, 9, 8), F.substring(digits, 17, 4)),
    ).otherwise(F.raise_error(F.concat(F.lit("a log position has 10 bytes: "), F.coalesce(lsn, F.lit("null")))))


def compare(left: Column, right: Column) -> Column:
    """LN4: -1, 0 or 1 in byte order; a null on either side fails the job."""
    return (
        F.when(left.isNull() | right.isNull(), F.raise_error(F.lit("cannot compare a null log position")))
        .when(left < right, -1)
        .when(left > right, 1)
        .otherwise(0)
        .cast("int")
    )


def following(lsn: Column) -> Column:
    """LN5: the position right after, carrying from the 16-bit slot over two 32-bit parts."""

    def part(start: int, size: int) -> Column:
        return F.conv(F.substring(lsn, start, size), 16, 10).cast("bigint")

    slot = part(17, 4) + 1
    block = part(9, 8) + F.shiftright(slot, 16)
    file = part(1, 8) + F.shiftright(block, 32)
    text = F.concat(
        hex_digits(file, 8),
        hex_digits(block.bitwiseAND(F.lit(0xFFFFFFFF)), 8),
        hex_digits(slot.bitwiseAND(F.lit(0xFFFF)), 4),
    )
    return F.when(lsn == HIGHEST, F.raise_error(F.lit("no log position follows the highest one"))).when(
        lsn.isNotNull(), text
    )
