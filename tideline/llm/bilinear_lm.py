"""Log-bilinear language model, trained in numpy with noise-contrastive estimation.

Tokens are the words of a text and one end mark after them. Each word belongs to a class: the most frequent words are
classes of their own; the other words are grouped by their last bytes, the groups with the most tokens again being
classes of their own and the remainder one class. The probability of a token is that of its class after the classes of the
``CONTEXT`` tokens before it, times that of the token in its class.

**Classes.** The log-bilinear model predicts a vector from the vectors of the context, each through a matrix of its
own, and scores a class by the product with the class's vector, plus its bias. Training is noise-contrastive: each
pair of context and class, as often as the whole training text has it, is to be told from ``NOISE`` pairs whose class
comes from the class frequencies. Nothing is drawn: each pass takes every counted pair with its count and every noise pair
with its expected number. The loss may rise for a pass; passes go on until ``PATIENCE`` of them have not lowered the least loss by
a share of ``ENOUGH``, and the parameters of the least loss count. Counts of all
pairs are summed up by Spark and are at most ``CLASSES`` ** (``CONTEXT`` + 1) numbers, whatever the input, so the fit is
one numpy program over all training tokens. The number of classes is fixed and does not grow with the text; words in a
class share its context scores. Scores are normalised
afterwards: one batched matrix product gives the log-probabilities of all classes after all contexts.

**Words.** In a class, a word has the share (count + 1) / (tokens of the class + words of the class + 1); the last part is for all
unknown words together, each of which gets all of it. Counts are exact and of all training tokens. The ``FREQUENT``
most frequent words go to every task; the counts of the others are joined.

Lower case is that of A-Z; words are runs without ASCII white space. Null text counts as empty and has one token, the
end. Each row gets a row; with nothing to learn from, all scores are those of an unknown word. An empty table gives
an empty result. Columns besides id and text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import map_batches, pieces, texts
from tideline.session import stage

CLASSES = 128
WORD_CLASSES = 90
#: Classes of one frequent word each, the end mark among them. The others are of word endings.

CONTEXT = 2
SUFFIX = 2
#: Bytes of a word that decide its class.

FREQUENT = 200_000
#: About so many frequent words at most are handed to every task.

SIZE = 24
NOISE = 16
RATE = 0.05
PART = 1024
#: Contexts whose scores are held at once.

ENOUGH, PATIENCE = 2e-4, 8
#: Training ends when so many passes over all pairs together lower the least loss by less than this share.

END = b""
#: The end mark; no word is empty.

COUNTED = 400_000
#: Distinct words a task counts before it hands its counts on.


def words(row: bytes) -> list[bytes]:
    return row.lower().split()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    for piece in pieces(batches):
        for row in texts(piece.column(0)):
            seen.update(words(row))
            seen[END] += 1
        if len(seen) > COUNTED:
            yield told()
            seen.clear()
    yield told()


@dataclass
class Classes:
    """Which class a word is in: by the word itself, else by its ending, else the last class."""

    by_word: dict[bytes, int]
    by_suffix: dict[bytes, int]

    def of(self, word: bytes) -> int:
        found = self.by_word.get(word)
        return self.by_suffix.get(word[-SUFFIX:], CLASSES - 1) if found is None else found


class _Known(dict):
    """Class of every word met, found once. Starts anew when it has grown large."""

    def __init__(self, classes: Classes):
        self.classes = classes

    def __missing__(self, word: bytes) -> int:
        if len(self) > COUNTED:
            self.clear()
        found = self[word] = self.classes.of(word)
        return found


def _class_rows(known: _Known, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all tokens, ``CONTEXT`` end marks before each text, and where each text's begin."""
    end = known[END]
    flat: list[int] = []
    sizes = [0]
    for row in rows:
        flat.extend([end] * CONTEXT)
        flat.extend(map(known.__getitem__, words(row)))
        flat.append(end)
        sizes.append(len(flat))
    return np.array(flat, np.int64), np.array(sizes, np.int64)


def _grams(flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Context and class of every token as one number; nothing for the marks before the texts."""
    gram = flat[CONTEXT:].copy() if len(flat) > CONTEXT else np.zeros(0, np.int64)
    for k in range(1, CONTEXT + 1):
        gram += flat[CONTEXT - k : len(flat) - k] * CLASSES**k
    keep = np.ones(len(flat), bool)
    for k in range(CONTEXT):
        keep[begins[:-1] + k] = False
    return gram[keep[CONTEXT:]]


def _gram_counts(sent):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Known(sent.value), np.zeros(CLASSES ** (CONTEXT + 1), np.int64)
        for piece in pieces(batches):
            total += np.bincount(_grams(*_class_rows(known, texts(piece.column(0)))), minlength=len(total))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["gram", "n"])

    return count


def fitted(gram: np.ndarray, n: np.ndarray, seed: int = 1) -> np.ndarray:
    """Normalised log10-probabilities of all classes (columns) after all contexts (rows)."""
    rng = np.random.default_rng(seed)
    share = n / max(1, n.sum())
    noise = np.bincount(gram % CLASSES, weights=share, minlength=CLASSES) + 1e-9
    noise /= noise.sum()
    told, wanted = rng.normal(0, 0.1, (CLASSES, SIZE)), rng.normal(0, 0.1, (CLASSES, SIZE))
    through = np.stack([np.eye(SIZE) / (k + 1) for k in range(CONTEXT)])
    bias = np.log(noise)
    params = [told, wanted, through, bias]
    squares = [np.zeros_like(p) + 1e-6 for p in params]
    log_noise = np.log(NOISE * noise)
    order = np.argsort(gram)
    gram, share = gram[order], share[order]
    seen, row = np.unique(gram // CLASSES, return_inverse=True)
    column, weight = gram % CLASSES, np.bincount(row, weights=share, minlength=len(seen))
    parts = [(begin, min(begin + PART, len(seen))) for begin in range(0, len(seen), PART)]
    least, mark, waited, best = np.inf, np.inf, 0, [p.copy() for p in params]
    while parts and waited < PATIENCE:
        loss, steps = 0.0, [np.zeros_like(p) for p in params]
        for begin, end in parts:
            context = [seen[begin:end] // CLASSES**k % CLASSES for k in range(CONTEXT)]
            vectors = [told[c] for c in context]
            guess = sum(v @ m for v, m in zip(vectors, through, strict=True))
            score = np.clip(guess @ wanted.T + bias - log_noise, -30, 30)
            true = np.zeros(score.shape)
            low, high = np.searchsorted(row, [begin, end])
            true[row[low:high] - begin, column[low:high]] = share[low:high]
            false = weight[begin:end, None] * (NOISE * noise)
            away = np.exp(-score)
            soft = np.log1p(away)
            loss += float((true * soft + false * (score + soft)).sum())
            # The gradient of the two-way decision: pairs of the text by their count, noise pairs by what is expected of them.
            slope = true - (true + false) / (1 + away)
            to_guess = slope @ wanted
            steps[1] += slope.T @ guess
            steps[3] += slope.sum(axis=0)
            for k in range(CONTEXT):
                steps[2][k] += vectors[k].T @ to_guess
                np.add.at(steps[0], context[k], to_guess @ through[k].T)
        if loss < least:
            least, best = loss, [p.copy() for p in params]
        waited += 1
        if least < mark * (1 - ENOUGH):
            mark, waited = least, 0
        for param, square, step in zip(params, squares, steps, strict=True):
            square += step * step
            param += RATE * step / np.sqrt(square)
    told, wanted, through, bias = best
    contexts = np.arange(CLASSES**CONTEXT)
    guess = sum(told[contexts // CLASSES**k % CLASSES] @ through[k] for k in range(CONTEXT))
    score = guess @ wanted.T + bias
    score -= score.max(axis=1, keepdims=True)
    score -= np.log(np.exp(score).sum(axis=1, keepdims=True))
    return (score / np.log(10)).astype(np.float32)


@dataclass
class Model:
    """What scoring needs; ``counts`` is the table of all words, the rest is of bounded size."""

    classes: Classes
    table: np.ndarray
    frequent: dict[bytes, int]
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    distinct: int
    counts: DataFrame

    def in_class(self, of: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Log10 share of words seen ``n`` times among those of their class."""
        return np.log10((n + 1) / (self.class_tokens[of] + self.class_words[of] + 1))


def train(texts_of: DataFrame, text: str = "text") -> Model:
    """Learn from all rows of ``texts_of``."""
    spark = texts_of.sparkSession
    rows = texts_of.select(F.col(text).alias("text"))
    counts = map_batches(rows, _word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stage(counts.where("n > 0"), "word-counts")
    # Words by sixteenths of an octave of their count: a table of a few hundred rows at most says which count
    # leaves few enough words above it.
    octave = F.floor(F.log2("n") * 16).cast("int")
    steps = sorted(counts.groupBy(octave.alias("step")).count().collect(), reverse=True)
    above, least = 0, 1 << 30
    for step, count in steps:
        above += count
        if above > FREQUENT:
            break
        least = step
    frequent = {bytes(r["word"]): r["n"] for r in counts.where(octave >= least).collect()}
    top = sorted(frequent, key=lambda w: (w != END, -frequent[w], w))[:WORD_CLASSES]
    by_word = {w: k for k, w in enumerate(top)}
    suffix = F.when(F.octet_length("word") < SUFFIX, F.col("word")).otherwise(F.substring("word", -SUFFIX, SUFFIX))
    other = counts.where(~F.col("word").isin([bytearray(w) for w in top])) if top else counts
    endings = other.groupBy(suffix.alias("suffix")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"))
    endings = stage(endings, "endings")
    best = endings.orderBy(F.desc("n"), "suffix").limit(CLASSES - 1 - WORD_CLASSES).collect()
    classes = Classes(by_word, {bytes(r["suffix"]): WORD_CLASSES + k for k, r in enumerate(best)})
    tokens, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for word, k in by_word.items():
        tokens[k], distinct[k] = frequent[word], 1
    for r in best:
        k = classes.by_suffix[bytes(r["suffix"])]
        tokens[k], distinct[k] = r["n"], r["words"]
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens[CLASSES - 1], distinct[CLASSES - 1] = total[0] - tokens.sum(), total[1] - distinct.sum()
    sent = spark.sparkContext.broadcast(classes)
    grams = map_batches(rows, _gram_counts(sent), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    table = fitted(grams.column("gram").to_numpy(), grams.column("n").to_numpy())
    return Model(classes, table, frequent, tokens, distinct, int(total[0]), int(total[1]), counts.where(octave < least))


def scored(docs: DataFrame, model: Model, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns ``keep`` of each row with ``n_tokens, n_known, train_tokens, base_score, score``."""
    rest = model.counts
    light = (model.classes, model.table, model.frequent, model.class_tokens, model.class_words, model.tokens, model.distinct)
    sent = docs.sparkSession.sparkContext.broadcast(light)
    named = docs.select(*keep, F.col(text).alias("__text"))
    kept = named.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema.fields[:-1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value, None)
        known = _Known(own.classes)
        flat_table = own.table.reshape(-1)
        base_zero = np.log10(1 / (own.tokens + own.distinct + 1))
        seen = own.frequent.get
        for piece in pieces(batches, "__text"):
            rows = texts(piece.column(len(kept)))
            flat, begins = _class_rows(known, rows)
            score = flat_table[_grams(flat, begins)].astype(np.float64)
            sizes = np.diff(begins) - CONTEXT
            owner = np.repeat(np.arange(len(rows)), sizes)
            own_class = flat[np.arange(len(owner)) + CONTEXT * (owner + 1)]
            listed = [w for row in rows for w in (*words(row), END)]
            count = np.array([seen(w, 0) for w in listed], np.int64)
            # Words that are not frequent count as unknown here; what is known of them is added by the join.
            base = np.log10(count + 1.0) + base_zero
            score += own.in_class(own_class, count)
            rare = [[] for _ in rows]
            for k in np.flatnonzero(count == 0):
                rare[owner[k]].append(listed[k])
            add = lambda x: np.bincount(owner, weights=x, minlength=len(rows))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    *piece.columns[:-1],
                    pa.array(sizes),
                    pa.array(add(count > 0).astype(np.int64)),
                    pa.array(add(base)),
                    pa.array(add(score)),
                    pa.array(rare, pa.list_(pa.binary())),
                ],
                [*kept, "n_tokens", "n_known", "base_score", "score", "rare"],
            )

    found = map_batches(named, work, f"{schema}, n_tokens long, n_known long, base_score double, score double, rare array<binary>")
    found = stage(found.withColumn("__row", F.monotonically_increasing_id()), "scored")
    # A word gains the logarithm of its count plus one, in either score, as both shares have the count above the line.
    met = found.select("__row", F.explode("rare").alias("word")).groupBy("__row", "word").agg(F.count(F.lit(1)).alias("times"))
    gain = met.join(rest, "word").groupBy("__row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("gain"))
    gained = found.drop("rare").join(gain, "__row", "left")
    more = F.coalesce("gain", F.lit(0.0))
    return gained.select(
        *kept,
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """A seventh of the documents, by the checksum of their id as text; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def scores_of_documents(spark, sf_dir: str) -> DataFrame:
    """op6: scores of every document, learned from the documents that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs, train(docs.where(~held_out())), [F.col("doc_id"), held_out().alias("held_out")])
