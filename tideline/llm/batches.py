"""Arrow batches of text as byte arrays: pieces of bounded size, word positions, word hashes, mixing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Text worked on at once inside a task; one longer text is a piece of its own.
PIECE_BYTES = 4_000_000

# The same in a stage of a pipeline, whose workers keep some memory of the stages before.
STAGE_BYTES = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def map_batches(rows: DataFrame, work: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found it.

    A cluster that keeps it elsewhere ships it as for any package (``--py-files``).
    """
    environment = rows.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH"), root]))
    return rows.mapInArrow(work, schema)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants): every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


def texts(column: pa.Array) -> list[bytes]:
    """The texts of a column in UTF-8; null is the empty text."""
    return [b"" if text is None else text for text in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows, cut so that the texts of a piece hold about ``limit`` bytes."""
    for batch in batches:
        sizes = [len(t) for t in texts(batch.column(batch.schema.get_field_index(text)))]
        begin, held = 0, 0
        for at, size in enumerate(sizes):
            if at > begin and held + size > limit:
                yield batch.slice(begin, at - begin)
                begin, held = at, 0
            held += size
        if len(sizes) > begin:
            yield batch.slice(begin)


def joined(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a newline after each, and where each begins (one more entry: the end)."""
    data = np.frombuffer(b"\n".join(rows) + b"\n", np.uint8)
    begins = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in rows], out=begins[1:])
    return data, begins


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, every other byte as it is."""
    return _LOWER[data]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run without ASCII white space."""
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, by a polynomial prefix sum."""
    with np.errstate(over="ignore"):
        powers = np.empty(len(data) + 1, np.uint64)
        powers[0] = 1
        powers[1:] = _BASE
        np.multiply.accumulate(powers, out=powers)
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=prefix[1:])
        inverse = np.empty(len(data) + 1, np.uint64)
        inverse[0] = 1
        inverse[1:] = _BASE_INVERSE
        np.multiply.accumulate(inverse, out=inverse)
        return mix((prefix[end] - prefix[begin]) * inverse[begin])
