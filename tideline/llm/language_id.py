"""Language identification by prediction by partial matching over bytes.

Each language has context trees of orders 0 to ``ORDER`` grown from its training texts and then frozen. A byte's code
length in a language is read from the longest context that the language has seen: with escape method C, a context
with ``n`` occurrences and ``d`` distinct followers gives a follower seen ``c`` times the share ``c / (n + d)`` and
the escape ``d / (n + d)``, after which the next shorter context is asked; below order 0 all byte classes are equal.
A text belongs to the language in which its code is shortest. As the statistics are frozen, the code length of every
known gram is worked out once for all languages, and scoring is a table lookup per byte, in numpy.

Bytes are folded first: A-Z to a-z, every run of other ASCII characters to one space, all bytes above 127 kept.

Null text, empty text and text without a letter give ``und`` with score 0; so does every text if there is nothing to
learn from. Ties go to the language that sorts first. Rows are scored one by one, so repeated rows get equal results
and an empty table an empty result. Columns besides the id, text and language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import STAGE_BYTES, map_batches, pieces, texts

ORDER = 3
#: Longest context in bytes. A gram (context and byte) has to fit in 32 bits.

TRAINING_ROWS = 2_000
#: About so many texts a language are learned from (chosen by a hash of their text, so that any input gives the
#: same choice); fewer texts are all taken.

UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def folded(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of all texts, ``ORDER`` spaces before each, and the begin of each (one more entry: the end)."""
    pad = b" " * ORDER
    data = _FOLD[np.frombuffer(pad + pad.join(rows) + b" ", np.uint8)]
    sizes = np.array([len(r) + ORDER for r in rows], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(np.arange(len(rows)), sizes)
    data = data[: begins[-1]]
    first = np.zeros(len(data), bool)
    for k in range(ORDER):
        first[begins[:-1] + k] = True
    keep = first | (data != 32) | np.concatenate(([True], data[:-1] != 32))
    kept = np.concatenate(([0], np.cumsum(np.bincount(owner[keep], minlength=len(rows)))))
    return data[keep], kept


def grams(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each byte of a text, and the text it belongs to."""
    sizes = np.diff(begins) - ORDER
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(owner)) + ORDER * (owner + 1)
    gram = np.zeros(len(owner), np.uint32)
    for k in range(ORDER, -1, -1):
        gram = (gram << np.uint32(8)) | data[at - k].astype(np.uint32)
    return gram, owner


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        langs = np.array(piece.column(1).to_pylist(), object)
        rows = texts(piece.column(0))
        for lang in sorted(set(langs)):
            gram, _ = grams(*folded([r for r, own in zip(rows, langs, strict=True) if own == lang]))
            values, counts = np.unique(gram, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(values), pa.string()), pa.array(values, pa.int64()), pa.array(counts, pa.int64())],
                ["lang", "gram", "n"],
            )


@dataclass
class Model:
    """Frozen code lengths: for each order the sorted grams, their bits in each language, and the escape bits."""

    langs: list[str]
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def lengths(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of each gram in each language."""
        if order < 0:
            return np.full((len(gram), len(self.langs)), 8.0, np.float32)
        key = gram & np.uint32((1 << 8 * (order + 1)) - 1)
        at = np.minimum(np.searchsorted(self.grams[order], key), len(self.grams[order]) - 1)
        known = self.grams[order][at] == key
        found = self.bits[order][at]
        if not known.all():
            rest = np.flatnonzero(~known)
            below = self.lengths(gram[rest], order - 1)
            context = key[rest] >> np.uint32(8)
            to = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            seen = (self.contexts[order][to] == context)[:, None]
            found[rest] = below + np.where(seen, self.escapes[order][to], 0)
        return found


def freeze(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Code lengths of all known grams from counts of the longest grams."""
    model = Model(langs, [], [], [], [])
    for order in range(ORDER + 1):
        short = gram & np.uint32((1 << 8 * (order + 1)) - 1)
        known, at = np.unique(short, return_inverse=True)
        counts = np.zeros((len(known), len(langs)))
        np.add.at(counts, (at, lang), n)
        contexts, of = np.unique(known >> np.uint32(8), return_inverse=True)
        total = np.zeros((len(contexts), len(langs)))
        kinds = np.zeros((len(contexts), len(langs)))
        np.add.at(total, of, counts)
        np.add.at(kinds, of, counts > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escapes = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
            own = -np.log2(counts / (total + kinds)[of])
        below = model.lengths(known, order - 1)
        model.grams.append(known)
        model.contexts.append(contexts)
        model.escapes.append(escapes.astype(np.float32))
        model.bits.append(np.where(counts > 0, own, escapes[of] + below).astype(np.float32))
    return model


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAINING_ROWS) -> Model:
    """Learn from about ``rows`` texts of each language, fewer if there are fewer; copies of a text count once.

    Only the gram counts of those texts come to the driver. Without any gram there is nothing to learn from.
    """
    labelled = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    # One row per language, a small table of its own kind.
    shares = {r["lang"]: rows / r["rows"] for r in sizes.collect()}
    if not shares:
        return Model([], [], [], [], [])
    share = F.coalesce(*[F.when(F.col("lang") == name, F.lit(min(1.0, part))) for name, part in shares.items()])
    place = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.where(place < share).distinct()
    counted = (
        map_batches(chosen, _gram_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .orderBy("lang", "gram")
        .toArrow()
    )
    if not counted.num_rows:
        return Model([], [], [], [], [])
    langs = sorted(shares)
    number = {name: k for k, name in enumerate(langs)}
    lang_at = np.array([number[x] for x in counted.column("lang").to_pylist()], np.int64)
    return freeze(langs, lang_at, counted.column("gram").to_numpy().astype(np.uint32), counted.column("n").to_numpy())


def has_letter(row: bytes) -> bool:
    return any(map(str.isalpha, row.decode("utf-8", "replace")))


def predictions(model: Model, rows: list[bytes]) -> tuple[list[str], list[float], list[float]]:
    """Language, its share among all languages, and bits a byte of each text."""
    if not model.langs or not rows:
        return [UNKNOWN] * len(rows), [0.0] * len(rows), [0.0] * len(rows)
    gram, owner = grams(*folded(rows))
    total = np.zeros((len(rows), len(model.langs)))
    for begin in range(0, len(gram), 1 << 19):
        bits, own = model.lengths(gram[begin : begin + (1 << 19)]), owner[begin : begin + (1 << 19)]
        cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        total[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.float64)
    best = total.argmin(axis=1)
    least = total[np.arange(len(rows)), best]
    share = 1 / np.exp2(np.maximum(least[:, None] - total, -1000)).sum(axis=1)
    size = np.maximum(np.bincount(owner, minlength=len(rows)), 1)
    letters = [has_letter(r) for r in rows]
    return (
        [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)],
        [float(s) if ok else 0.0 for s, ok in zip(share, letters, strict=True)],
        [float(x) for x in least / size],
    )


def identify(docs: DataFrame, model: Model, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with ``lang_pred``, ``score`` and ``bits`` (a byte, in that language)."""
    frozen = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.columns[:-1]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields[:-1])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "__text"):
            lang, score, bits = predictions(frozen.value, texts(piece.column(len(kept))))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())],
                [*kept, "lang_pred", "score", "bits"],
            )

    return map_batches(docs, scored, f"{schema}lang_pred string, score double, bits double")


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is told with a share of at least ``least``."""
    frozen = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, STAGE_BYTES):
            lang, score, _ = predictions(frozen.value, texts(piece.column(at)))
            yield piece.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(lang, score, strict=True)], pa.bool_()))

    return map_batches(docs, chosen, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the documents, by the checksum of their id as text; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_of_documents(spark, sf_dir: str) -> DataFrame:
    """op9: language of every document, learned from the documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()))
    return identify(docs, model, [F.col("doc_id"), held_out().alias("held_out")])
