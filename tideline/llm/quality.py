"""Quality classifier over learned embeddings of hashed words and character n-grams.

A text is a bag of features: its words, pairs of neighbouring words, and the n-grams of code points inside each word
with a mark for its borders, all hashed into ``BUCKETS`` rows of a matrix. A pair of two equal words is one feature of
its own, whatever the word. The vectors of a text's features are averaged, and a softmax over an output matrix gives the
chance of each label. Both matrices are trained by stochastic gradient descent in numpy over small batches, with a step
that falls to zero.

Training sees a bounded sample of labelled rows: about ``TRAINING_ROWS`` for each label, chosen by a hash of the id and
weighted by the rows that they stand for, never more than four times that. They are whole texts; their features are counted in
Spark tasks. As the mean and the output layer are both linear, the trained model is folded into one number a bucket, and
scoring adds up one number a feature of the whole text.

Words are runs without ASCII white space. Null and empty texts have the feature that marks the end of a text alone. With no
labelled rows every score is 0.5; with one label only, that label's rows teach the model. Labels other than 0 and 1, null
ids and null labels teach nothing. Rows are scored one by one, so repeated rows get equal results, and an empty table
gives an empty result. Columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import map_batches, mix, pieces, span_hashes, texts

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
TRAINING_ROWS = 1_500
#: Labelled rows learned from, for each label.

#: Numbers a vector, passes over the sample, texts a step, first step.
DIMENSION, EPOCHS, BATCH, STEP = 4, 5, 32, 1.0
THRESHOLD = 0.3

_SPACE = np.zeros(128, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_END, _SAME = np.uint64(1), np.uint64(2)
_PIECE = 1_000_000


def features(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature of every text, and the text that it belongs to; in no order."""
    # One blank before and after each text keeps words and n-grams apart.
    units = [np.frombuffer(b" \0\0\0" + row.decode("utf-8", "replace").encode("utf-32-le") + b" \0\0\0", "<u4") for row in rows]
    data = np.concatenate(units) if units else np.zeros(0, np.uint32)
    own = np.repeat(np.arange(len(rows)), [len(u) for u in units])
    blank = data < 128
    blank[blank] = _SPACE[data[blank]]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begin, end = edges[0::2], edges[1::2]
    word = span_hashes(data, begin, end)
    of = own[begin]
    hashes, owners = [word, np.full(len(rows), _END)], [of, np.arange(len(rows))]
    both = of[1:] == of[:-1]
    pair = np.where(word[1:] == word[:-1], _SAME, mix(word[1:] + np.uint64(3) * word[:-1]))
    hashes.append(pair[both])
    owners.append(of[1:][both])
    # A word of n letters has n + 2 places, its two borders included.
    marked = np.where(blank, np.uint32(0x110000), data).astype(np.uint64) + np.uint64(1)
    gap = np.concatenate(([0], np.cumsum(blank)))
    for size in GRAMS:
        if len(data) < size:
            continue
        places = len(data) - size + 1
        # No border inside: blanks may stand first and last alone.
        inside = gap[size - 1 : size - 1 + places] - gap[1 : 1 + places] == 0
        at = np.flatnonzero(inside & ~(blank[:places] & blank[1 : 1 + places]))
        gram = np.full(len(at), size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                gram = gram * np.uint64(0x100000001B3) + marked[at + k]
        hashes.append(mix(gram))
        owners.append(own[at])
    buckets = (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int32)
    return buckets, np.concatenate(owners)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, weight, and the distinct buckets of each text with their shares."""
    for piece in pieces(batches, "text", _PIECE):
        buckets, owner = features(texts(piece.column(0)))
        key, n = np.unique(owner.astype(np.int64) * BUCKETS + buckets, return_counts=True)
        row = key // BUCKETS
        cuts = np.searchsorted(row, np.arange(piece.num_rows + 1))
        total = np.add.reduceat(n, cuts[:-1])
        found = (key % BUCKETS).astype("<i4")
        share = (n / total[row]).astype("<f4")
        yield pa.RecordBatch.from_arrays(
            [
                piece.column(1),
                piece.column(2),
                pa.array([found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                pa.array([share[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            ],
            ["label", "weight", "buckets", "shares"],
        )


@dataclass
class Model:
    """What a feature adds to the odds of label 1 (in logarithms), bucket by bucket, and the odds without features."""

    weights: np.ndarray
    prior: float

    def scores(self, rows: list[bytes]) -> np.ndarray:
        """Chance of label 1 of each text."""
        if not rows:
            return np.zeros(0)
        buckets, owner = features(rows)
        total = np.bincount(owner, self.weights[buckets], minlength=len(rows))
        odds = total / np.bincount(owner, minlength=len(rows)) + self.prior
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fitted(bags: list[tuple[int, float, np.ndarray, np.ndarray]], seed: int = 1) -> Model:
    """Stochastic gradient descent over ``(label, weight, buckets, shares)``."""
    if not bags:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIMENSION), np.float32) - 0.5) / DIMENSION
    output = np.zeros((DIMENSION + 1, 2), np.float32)
    label = np.array([b[0] for b in bags])
    weight = np.array([b[1] for b in bags], np.float64)
    weight = (weight / weight.mean()).astype(np.float32)
    steps, done = EPOCHS * -(-len(bags) // BATCH), 0
    # Squared gradients seen so far set the step of each bucket and of the output.
    seen, seen_out = np.full(BUCKETS, 1e-8, np.float32), np.full_like(output, 1e-8)
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for begin in range(0, len(bags), BATCH):
            part = order[begin : begin + BATCH]
            buckets = np.concatenate([bags[k][2] for k in part])
            shares = np.concatenate([bags[k][3] for k in part])
            cuts = np.concatenate(([0], np.cumsum([len(bags[k][2]) for k in part])))
            hidden = np.add.reduceat(vectors[buckets] * shares[:, None], cuts[:-1])
            hidden = np.concatenate((hidden, np.ones((len(part), 1), np.float32)), axis=1)
            logits = hidden @ output
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(part)), label[part]] -= 1
            error = chance * weight[part][:, None] / len(part)
            rate = STEP * (1 - done / steps)
            down = hidden.T @ error
            back = error @ output[:-1].T
            seen_out += down * down
            output -= rate * down / np.sqrt(seen_out)
            known, at = np.unique(buckets, return_inverse=True)
            change = np.zeros((len(known), DIMENSION), np.float32)
            each = np.repeat(back, np.diff(cuts), axis=0) * shares[:, None]
            for k in range(DIMENSION):
                change[:, k] = np.bincount(at, each[:, k], minlength=len(known))
            seen[known] += (change * change).mean(axis=1)
            vectors[known] -= rate * change / np.sqrt(seen[known])[:, None]
            done += 1
    odds = output[:, 1] - output[:, 0]
    return Model((vectors @ odds[:-1]).astype(np.float32), float(odds[-1]))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAINING_ROWS) -> Model:
    """Learn from about ``rows`` labelled texts of each label; only they, as bags of buckets, come to the driver."""
    labels = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label")).where("__id IS NOT NULL AND label IN (0, 1)")
    sizes = {r["label"]: r["rows"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).collect()}
    if not sizes:
        return fitted([])
    place = F.pmod(F.xxhash64("__id", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.coalesce(*[F.when(F.col("label") == k, F.lit(min(1.0, rows / n))) for k, n in sizes.items()])
    # The ids that are learned from: at most some thousand, whatever the size of the tables.
    chosen = labels.withColumn("weight", (1 / share).cast("double")).where(place < share).orderBy(F.xxhash64("__id")).limit(4 * rows)
    # Broadcast: no more than that limit.
    texts_of = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text"))
    learned = texts_of.join(F.broadcast(chosen), "__id").orderBy(F.xxhash64("__id", "text")).limit(4 * rows).select("text", "label", "weight")
    found = map_batches(learned, _bags, "label int, weight double, buckets binary, shares binary").toArrow()
    columns = [found.column(k).to_pylist() for k in range(4)]
    return fitted([(y, w, np.frombuffer(b, "<i4"), np.frombuffer(s, "<f4")) for y, w, b, s in zip(*columns, strict=True)])


def scored(docs: DataFrame, model: Model, keep: list[Column], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` of each row with ``score`` (chance of label 1) and ``predicted``."""
    frozen = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*keep, F.col(text).alias("__text"))
    kept = docs.columns[:-1]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields[:-1])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "__text", _PIECE):
            found = frozen.value.scores(texts(piece.column(len(kept))))
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(found), pa.array((found >= threshold).astype(np.int32))], [*kept, "score", "predicted"])

    return map_batches(docs, marked, f"{schema}score double, predicted int")


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the documents, by the checksum of their id as text; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_of_documents(spark, sf_dir: str) -> DataFrame:
    """op12: quality of every document, learned from the labels of documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    return scored(docs, model, [F.col("doc_id"), held_out().alias("held_out")])
