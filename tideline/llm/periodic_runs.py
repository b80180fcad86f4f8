"""Periodic runs of words, found by an online sparse dynamic program over diagonals.

A diagonal of lag ``q`` is a stretch in which each word equals the word ``q`` before it. A run of period ``q`` is a
diagonal of at least three periods, so for the power ``b`` of two between three eighths and three quarters of ``q`` it
holds three whole neighbouring blocks of ``b`` words that begin at multiples of ``b``. So a word that ends blocks asks
its earlier occurrences, the nearest first, for lags whose block it ends; where the three blocks before both agree (by
a rolling hash), the lag becomes active and its match length is counted back. Each further word lengthens the active
lags that it agrees with and ends the others, and a diagonal that ends with sufficient length gives its run at once. A
lag that is a multiple of an active one inside the same stretch has the same borders and a longer period, and is passed
over; hence each stretch is reported with its smallest period alone, and a text of one repeated word keeps one lag
active. Three blocks are longer than the lag, so an active lag always stands for a true repetition, of which few lie
over one word. Hashes only spare work: match lengths are counted on the words themselves.

A text of n words asks for at most n log n lags, however its words repeat. The state of a text is some 100 bytes a
word; texts are worked through one at a time.

Null and empty texts have no words and no run. A null id leaves its text unchanged. Repeated rows get equal results,
an empty table gives an empty result, and columns besides id and text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import map_batches, pieces, texts

LEAST_WORDS, LEAST_PERIODS = 6, 4
#: A run has at least so many words and so many periods.

_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_BLOCKS = 3


class Diagonals:
    """The state of one text: its words so far, where each stands, and the active lags."""

    def __init__(self, words: int = LEAST_WORDS, periods: int = LEAST_PERIODS):
        if words < 5 or periods < 4:
            raise ValueError("blocks are sure to lie inside runs of five words and four periods or more only")
        self.least_words, self.least_periods = words, periods
        self.words: list[bytes] = []
        self.places: dict[bytes, list[int]] = {}
        self.active: dict[int, int] = {}
        self.prefix = array("Q", [0])
        self.powers = [pow(_BASE, _BLOCKS, 1 << 64)]

    def push(self, word: bytes) -> list[tuple[int, int, int]]:
        """Take the next word; the runs ``(start, length, period)`` that it ends."""
        words, at, ended = self.words, len(self.words), []
        if self.active:
            for lag in [lag for lag in self.active if words[at - lag] != word]:
                ended += self._ended(lag, at)
        words.append(word)
        before = self.places.setdefault(word, [])
        self.prefix.append((self.prefix[at] * _BASE + hash(word)) & _MASK)
        if before:
            # The longest block that ends here is a power of two; so is the longest lag it serves, but for a factor.
            longest = (8 * ((at + 1) & -(at + 1)) - 1) // 3
            if at - before[-1] <= longest:
                self._asked(before, at, longest)
        before.append(at)
        return ended

    def close(self) -> list[tuple[int, int, int]]:
        """The runs that reach the end of the text."""
        return [run for lag in list(self.active) for run in self._ended(lag, len(self.words))]

    def _ended(self, lag: int, end: int) -> list[tuple[int, int, int]]:
        start = self.active.pop(lag) - lag
        return [(start, end - start, lag)] if end - start >= max(self.least_words, self.least_periods * lag) else []

    def _asked(self, before: list[int], at: int, longest: int) -> None:
        """Make active the lags to earlier occurrences whose block of words before agrees too."""
        words, active, prefix = self.words, self.active, self.prefix
        for place in reversed(before):
            lag = at - place
            if lag > longest:
                break
            if lag in active or any(lag % q == 0 and first - q <= place for q, first in active.items()):
                continue
            level = max((3 * lag).bit_length() - 3, 0)
            begin = place + 1 - (_BLOCKS << level)
            if begin < 0:
                continue
            while len(self.powers) <= level:
                self.powers.append(self.powers[-1] * self.powers[-1] & _MASK)
            power = self.powers[level]
            if (prefix[at + 1] - prefix[begin + lag] * power - prefix[place + 1] + prefix[begin] * power) & _MASK:
                continue
            first = at
            while first > lag and words[first - 1] == words[first - 1 - lag]:
                first -= 1
            active[lag] = first


def runs(words: Iterable[bytes]) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a text, by start, then period."""
    state = Diagonals()
    found = [run for word in words for run in state.push(word)]
    return sorted(found + state.close(), key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period; ``found`` by start."""
    out, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in found):
        if begin > at:
            out += words[at:begin]
        at = max(at, end)
    return out + words[at:]


def recurring(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document; a tenth of the documents, by the checksum of the id, are made periodic from some word on."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def with_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", change=None) -> DataFrame:
    """``doc_id``, ``words`` (their number), ``runs`` (all of them) and ``collapsed`` (the text without repeats).

    ``change(words, doc_id)`` may give other words to work on.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names = ["doc_id", "words", "runs", "collapsed"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "__text"):
            ids, sizes, all_runs, kept = piece.column(0).to_pylist(), [], [], []
            for own, row in zip(ids, texts(piece.column(1)), strict=True):
                words = row.split()
                words = change(words, own) if change else words
                here = runs(words)
                sizes.append(len(words))
                all_runs.append([{"start": s, "length": n, "period": q} for s, n, q in here])
                kept.append(b" ".join(collapsed(words, here)))
            columns = [piece.column(0), pa.array(sizes, pa.int64()), pa.array(all_runs, run), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, found, f"doc_id {kind}, words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest (ties: first start, then least period), and checksums of all runs and the kept words."""
    best = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"])))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        F.col("words").alias("n_words"),
    )


def runs_of_documents(spark, sf_dir: str) -> DataFrame:
    """op13: periodic runs of every document, a tenth of them made periodic first."""
    return digests(with_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), change=recurring))
