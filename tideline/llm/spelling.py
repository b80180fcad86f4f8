"""Spelling variants: words one edit apart, found in k-d trees over letter-count vectors.

Words are Latin-1 letters. A word's vector counts each letter; one edit changes it little: a replaced letter takes one
from one count and adds one to another (L1 distance two), an inserted or deleted letter changes one count by one. So
the words near a word of length ``n`` are looked for among those of lengths ``n - 1``, ``n`` and ``n + 1``, each length
a point set of its own, and a k-d tree prunes by box: a search may lie outside a box by one letter too many and one too
few, and by no more. What reaches a leaf is verified letter by letter.

The work is dealt by the same trees. For each length with more than ``CELL`` words a tree with that leaf size is grown
on the driver from a bounded sample; its leaves are the cells, every word lies in one, and a search goes to each cell
that its box test reaches. A cell's words come to one task before its searches, which then stream through it, so memory
is bounded by ``CELL`` words. A cell that is larger than that (anagrams have one vector, and a sample is only a sample)
is cut into blocks by a hash of the word, and its searches go to every block. Searches hand on the number of near words
and the best of them, not pairs.

Anagrams that fill more than a leaf are told apart by a table of each word without one of its letters, which is exact
and linear in their number.

A word's form is its near word with the largest count, if that is ``RATIO`` times its own; counts grow along forms, so
the chain of forms has an end, found by doubling pointers. Null texts have no words; a null id counts as ``null`` in the
checksum. Rows that repeat count twice; ties go to the word that is first in code-point order. An empty table gives an
empty result; columns besides id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import map_batches, pieces, texts
from tideline.session import stage

LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10

CELL = 30_000
#: Most words that a task searches at once; a length with fewer is one cell.

SAMPLE, MOST_CELLS = 400_000, 6_000
#: Words that the driver sees to place the borders of cells, and how many cells it makes at most (the borders that are
#: broadcast are no more than that); beyond ``CELL * MOST_CELLS`` words, cells are cut into blocks.

LEAF = 96
_LETTERS = 26 + 64
_LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
# a-z and then the upper half of Latin-1, in code-point order.
_INDEX = np.zeros(256, np.uint8)
_INDEX[97:123] = np.arange(26)
_INDEX[192:256] = np.arange(26, 90)


def without_letter(run: str, doc_id: int | None) -> str:
    """A 31st of all runs, by the checksum of id and run, lose a letter."""
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % 31 else run[:at] + run[at + 1 :]


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, change=None) -> DataFrame:
    """``word, n`` of all maximal runs of letters with at least ``least`` letters; ``change(run, doc_id)`` may give another word."""
    letters = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")
    held = 200_000

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        total: Counter = Counter()
        for piece in pieces(batches, "__text"):
            for own, row in zip(piece.column(0).to_pylist(), texts(piece.column(1)), strict=True):
                for run, n in Counter(letters.findall(row.decode().translate(_LOWER))).items():
                    word = change(run, own) if change else run
                    if len(word) >= least:
                        total[word] += n
            if len(total) > held:
                yield flushed()
                total = Counter()
        yield flushed()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    return map_batches(rows, counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words of one length as rows of letter numbers, in code-point order."""

    def __init__(self, words: list[bytes]):
        self.size = len(words[0]) if words else 0
        self.letters = _INDEX[np.frombuffer(b"".join(words), np.uint8)].reshape(len(words), self.size)

    def counts(self) -> np.ndarray:
        """How often each word has each letter."""
        out = np.zeros((len(self.letters), _LETTERS), np.uint8 if self.size < 256 else np.int32)
        row = np.arange(len(self.letters))
        for k in range(self.size):
            out[row, self.letters[:, k]] += 1
        return out


class Tree:
    """A k-d tree: each inner node asks whether a count is above a cut; leaves are numbered."""

    def __init__(self, counts: np.ndarray, leaf: int):
        """Grow over ``counts`` until no node has more than ``leaf`` rows or all rows of a node are equal."""
        self.nodes: list[tuple[int, int, int, int]] = []
        self.leaves = 0
        self.members: list[np.ndarray] = []
        waiting = [(np.arange(len(counts)), -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            found = self._cut(counts[rows]) if len(rows) > leaf else None
            if found is None:
                at = ~self.leaves
                self.leaves += 1
                self.members.append(rows)
            else:
                letter, cut = found
                at = len(self.nodes)
                self.nodes.append((letter, cut, 0, 0))
                above = counts[rows, letter] > cut
                waiting += [(rows[~above], at, 2), (rows[above], at, 3)]
            if parent >= 0:
                node = list(self.nodes[parent])
                node[side] = at
                self.nodes[parent] = tuple(node)
        self.root = 0 if self.nodes else -1

    @staticmethod
    def _cut(counts: np.ndarray) -> tuple[int, int] | None:
        """The letter and count that part the rows most evenly."""
        best = None
        for cut in range(int(counts.max(initial=0))):
            above = np.count_nonzero(counts > cut, axis=0)
            small = np.minimum(above, len(counts) - above)
            letter = int(small.argmax())
            if small[letter] and (best is None or small[letter] > best[0]):
                best = (small[letter], letter, cut)
            if best and not (above > best[0]).any():
                break
        return best and best[1:]

    def bare(self) -> Tree:
        """The borders alone."""
        self.members = []
        return self

    def reached(self, counts: np.ndarray, over: int, under: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the rows whose box test reaches them, with so many letters too many and too few allowed."""
        rows = np.arange(len(counts))
        waiting = [(self.root, rows, np.full(len(rows), over, np.int8), np.full(len(rows), under, np.int8))]
        while waiting:
            at, rows, more, less = waiting.pop()
            if not len(rows):
                continue
            if at < 0:
                yield ~at, rows
                continue
            letter, cut, below, above = self.nodes[at]
            own = counts[rows, letter].astype(np.int32)
            high = own > cut
            stays = ~high | ((own == cut + 1) & (more > 0))
            waiting.append((below, rows[stays], (more - high)[stays], less[stays]))
            stays = high | ((own == cut) & (less > 0))
            waiting.append((above, rows[stays], more[stays], (less - ~high)[stays]))


#: Letters too many and too few that a search may have, by how much longer it is than the words it looks among.
_SLACK = {0: (1, 1), 1: (1, 0), -1: (0, 1)}


_ONES = np.uint64(0x0101010101010101)
_LOW, _HIGH = _ONES * np.uint64(0x7F), _ONES * np.uint64(0x80)


def _packed(letters: np.ndarray) -> list[np.ndarray]:
    """Eight letters to a number, the first in the lowest byte."""
    wide = np.zeros((len(letters), -(-letters.shape[1] // 8) * 8), np.uint8)
    wide[:, : letters.shape[1]] = letters
    return list(wide.view("<u8").T)


def _unlike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The top bit of each byte in which ``a`` (rows) and ``b`` (columns) differ."""
    x = a[:, None] ^ b[None, :]
    return (((x & _LOW) + _LOW) | x) & _HIGH


def _one_edit(asked: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``asked`` (rows) and ``known`` (columns) are one edit apart."""
    k, m = asked.shape[1], known.shape[1]
    if k == m:
        return sum(np.bitwise_count(_unlike(a, b)) for a, b in zip(_packed(asked), _packed(known), strict=True)) == 1
    # The letters before the place of the extra one agree from the start, those after it from the end.
    if k > m:
        heads, tails = ((_packed(x), _packed(known)) for x in (asked[:, :-1], asked[:, 1:]))
    else:
        heads, tails = ((_packed(asked), _packed(x)) for x in (known[:, :-1], known[:, 1:]))
    good, seen = np.ones((len(asked), len(known)), bool), np.zeros((len(asked), len(known)), bool)
    for head, tail in zip(zip(*heads, strict=True), zip(*tails, strict=True), strict=True):
        from_start, from_end = _unlike(*head), _unlike(*tail)
        here = from_start != 0
        # Behind the first letter that differs from the start, and at it, none may differ from the end.
        first = from_start & (~from_start + np.uint64(1))
        good &= np.where(seen, from_end == 0, ~here | (from_end < first))
        seen |= here
    return good


def _keys(letters: np.ndarray, place: bool) -> Iterator[tuple[int, tuple[int, bytes]]]:
    """Each word without one of its letters; with the place of that letter or without."""
    for row, word in enumerate(letters):
        whole = word.tobytes()
        for k in range(len(whole)) if place else {whole[:k] + whole[k + 1 :]: k for k in range(len(whole))}.values():
            yield row, (k if place else -1, whole[:k] + whole[k + 1 :])


def _by_keys(asked: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same pairs as :func:`_one_edit`, by exact keys."""
    k, m = asked.shape[1], known.shape[1]
    full = lambda letters: ((row, (-1, word.tobytes())) for row, word in enumerate(letters))
    mine = full(asked) if k < m else _keys(asked, k == m)
    theirs = full(known) if m < k else _keys(known, k == m)
    table: dict = {}
    for row, key in theirs:
        table.setdefault(key, []).append(row)
    # Equal words share all keys; they are no edit apart.
    pairs = {(q, p) for q, key in mine for p in table.get(key, ()) if k != m or (asked[q] != known[p]).any()}
    rows = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return rows[:, 0], rows[:, 1]


class Cell:
    """The words of one cell, all of one length, ready to be searched."""

    def __init__(self, words: list[bytes], counts: list[int]):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[k] for k in order]
        self.n = np.array([counts[k] for k in order], np.int64)
        self.points = Words(self.words)
        self.tree = Tree(self.points.counts(), LEAF)

    def near(self, asked: Words) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``asked``, row of this cell) that are one edit apart."""
        vectors, left, right = asked.counts(), [], []
        for leaf, rows in self.tree.reached(vectors, *_SLACK[asked.size - self.points.size]):
            members = self.tree.members[leaf]
            if len(members) > LEAF:
                at, to = _by_keys(asked.letters[rows], self.points.letters[members])
                left.append(rows[at])
                right.append(members[to])
                continue
            step = max(1, 200_000 // len(members))
            for begin in range(0, len(rows), step):
                part = rows[begin : begin + step]
                at, to = np.nonzero(_one_edit(asked.letters[part], self.points.letters[members]))
                left.append(part[at])
                right.append(members[to])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(left), np.concatenate(right)

    def best(self, words: list[bytes]) -> Iterator[tuple[bytes, int, int, bytes]]:
        """Each of ``words`` with near words here: their number, and count and text of the best."""
        by_size: dict[int, list[bytes]] = {}
        for word in words:
            by_size.setdefault(len(word), []).append(word)
        for same in by_size.values():
            at, to = self.near(Words(same))
            order = np.lexsort((to, -self.n[to], at))
            at, to = at[order], to[order]
            firsts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else []
            totals = np.diff([*firsts, len(at)])
            for first, total in zip(firsts, totals, strict=True):
                yield same[at[first]], int(total), int(self.n[to[first]]), self.words[to[first]]


def borders(words: DataFrame, cell: int = CELL) -> dict[int, Tree]:
    """A tree for each length with more than ``cell`` words, grown from a bounded sample."""
    sizes = words.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > cell)
    large = {r["size"]: r["words"] for r in sizes.collect()}
    if not large:
        return {}
    total = sum(large.values())
    # Each cell is told from some 64 words, as long as the driver may see so many.
    share = min(1.0, 64 / cell, SAMPLE / total)
    cell = max(cell, total // MOST_CELLS)
    place = F.pmod(F.xxhash64("word", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = words.where(F.length("word").isin(list(large)) & (place < share)).select("word").toArrow().column("word").to_pylist()
    by_size: dict[int, list[bytes]] = {}
    for word in rows:
        by_size.setdefault(len(word), []).append(word.encode("latin-1"))
    return {size: Tree(Words(sample).counts(), max(1, int(cell * share * 0.7))).bare() for size, sample in by_size.items()}


def _cells(trees: dict[int, Tree], words: list[bytes], size: int, slack: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
    """Cells of words of length ``size`` that ``words``, all of one length, reach."""
    tree = trees.get(size)
    if tree is None:
        yield size << 20, np.arange(len(words))
        return
    for leaf, rows in tree.reached(Words(words).counts(), *slack):
        yield size << 20 | leaf, rows


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """``word, n_near, best_n, best`` for ``words (word, n)``: the parts that each cell knows, only where there are any."""
    spark = words.sparkSession
    known = spark.sparkContext.broadcast(borders(words, cell))

    def dealt(batches: Iterator[pa.RecordBatch], searches: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [word.encode("latin-1") for word in batch.column(0).to_pylist()]
            counts = batch.column(1).to_numpy()
            by_size: dict[int, list[int]] = {}
            for row, word in enumerate(own):
                by_size.setdefault(len(word), []).append(row)
            for size, rows in by_size.items():
                same, at = [own[row] for row in rows], np.array(rows)
                for more in (-1, 0, 1) if searches else (0,):
                    for place, found in _cells(known.value, same, size + more, _SLACK[-more] if searches else (0, 0)):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(found), place), pa.int64()),
                                batch.column(0).take(pa.array(at[found])),
                                pa.array(counts[at[found]], pa.int64()),
                            ],
                            ["cell", "word", "n"],
                        )

    schema = "cell long, word string, n long"
    points = map_batches(words, lambda batches: dealt(batches, False), schema)
    asked = map_batches(words, lambda batches: dealt(batches, True), schema)
    # Cells above the bound are cut into blocks by a hash; there are no more of them than cells, and mostly none.
    sizes = points.groupBy("cell").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > cell)
    blocks = stage(sizes.select("cell", F.ceil(F.col("words") / cell).cast("int").alias("blocks")), "blocks")
    blocks = F.broadcast(blocks)
    of = F.coalesce("blocks", F.lit(1))
    points = points.join(blocks, "cell", "left").withColumn("block", F.pmod(F.xxhash64("word", F.lit(13)), of).cast("int"))
    asked = asked.join(blocks, "cell", "left").withColumn("block", F.explode(F.sequence(F.lit(0), of - 1)))
    columns = ["cell", "block", "role", "word", "n"]
    both = points.withColumn("role", F.lit(0)).select(columns).union(asked.withColumn("role", F.lit(1)).select(columns))
    both = both.repartition("cell", "block").sortWithinPartitions("cell", "block", "role")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        counts: list[int] = []
        open_cell, here = None, None
        for batch in batches:
            cells, at, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cuts = (cells[1:] != cells[:-1]) | (at[1:] != at[:-1]) | (roles[1:] != roles[:-1])
            begins = np.concatenate(([0], np.flatnonzero(cuts) + 1, [len(cells)]))
            out: list[tuple[bytes, int, int, bytes]] = []
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                if begin == end:
                    continue
                if open_cell != (cells[begin], at[begin]):
                    open_cell, held, counts, here = (cells[begin], at[begin]), [], [], None
                words = [word.encode("latin-1") for word in batch.column(3).slice(begin, end - begin).to_pylist()]
                if roles[begin] == 0:
                    held += words
                    counts += batch.column(4).slice(begin, end - begin).to_pylist()
                elif held:
                    here = here or Cell(held, counts)
                    out += here.best(words)
            decoded = [[word.decode("latin-1") for word in column] for column in ([r[0] for r in out], [r[3] for r in out])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(decoded[0], pa.string()),
                    pa.array([r[1] for r in out], pa.int64()),
                    pa.array([r[2] for r in out], pa.int64()),
                    pa.array(decoded[1], pa.string()),
                ],
                ["word", "n_near", "best_n", "best"],
            )

    return map_batches(both, searched, "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms (word, form)``: the end of each chain, found in rounds that double the step."""
    known = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = stage(known.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not known.where("moved").head(1):
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, cell: int = CELL) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct ``words (word, n)``."""
    words = stage(words, "words")
    near = near_words(words, cell)
    none = [F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("bigint").alias("best_n"), F.lit(None).cast("string").alias("best")]
    parts = words.select("word", "n", *none).union(near.select("word", F.lit(None).cast("bigint"), "n_near", "best_n", "best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))))
    told = parts.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    form = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    told = stage(told.select("word", "n", "n_near", form["word"].alias("form"), (-form["n"]).alias("form_n")), "forms")
    ends = roots(told.where("form IS NOT NULL"))
    out = told.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_of_documents(spark, sf_dir: str) -> DataFrame:
    """op11: spelling variants of all frequent words of the documents, a 31st of their runs misspelt first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(counted_words(docs, change=without_letter).where(F.col("n") >= LEAST_COUNT))
