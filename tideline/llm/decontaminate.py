"""Passages of a benchmark in documents, with or without edits, by q-gram filtering and banded alignment.

Items are cut into overlapping windows of ``WINDOW`` bytes, one every ``STRIDE`` bytes; the last reaches to the end of the
item, and a shorter item is one window. A document holds an item if it holds one of its windows, so any passage of
``WINDOW + STRIDE`` bytes of an item is found, wherever it was cut out.

The q-gram lemma: if a window of ``n`` bytes is found in a text with at most ``e`` edits, then of any ``g`` of its
q-grams at least ``g - q * e`` are in the text unchanged, and all of them lie on diagonals (place in the text minus
place in the item) at most ``e`` apart. So the q-grams of the items are looked up at every byte of every text, hits
are counted per item and window in overlapping bands of diagonals, and only bands that reach the bound go to alignment, which
finds the least number of edits between the whole window and any stretch of the region. Nothing within the edit budget
is missed, and nothing beyond it is reported.

Bytes are folded first: A-Z to a-z, every run of white space to one space, a run of any other byte to ``REPEAT`` of it. The budget is ``EDITS`` of the
window's bytes, and never more than the lemma can filter. Grams that many items share, and grams of one repeated byte, are left
out of the count where enough others remain; the bound of these items is lowered by as much. Items shorter than a q-gram are
looked for as they are.

Null or empty texts and items match nothing. Null ids are returned as they are. Repeated documents are each reported;
items with equal texts, too. Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tideline.llm.batches import PIECE_BYTES, STAGE_BYTES, joined, lowered, map_batches, mix, pieces, texts

Q = 8
EDITS = 0.08
#: Edits allowed for each byte of the item. Must stay below 1 / Q.

WINDOW, STRIDE = 160, 40
#: Bytes of a window, and from one to the next. A window holds a stride and a gram at least.

REPEAT = 16
#: As much of a run of one byte counts, so that rulers and padding cost no more hits than words. A power of two.

COMMON = 4
#: Grams in more items than this are left out where the lemma allows it.

BLOCK_BYTES = 16_000_000
#: Bytes of items that are searched for at once; a larger benchmark is searched for block by block.

_FILTER_BITS = 22


# a-z for A-Z, a space for white space, every other byte for itself.
_FOLD = lowered(np.arange(256, dtype=np.uint8))
_FOLD[9:14] = 32


def _folded(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All folded texts in one array, a space after each, where each begins, and which bytes were dropped."""
    data, begins = joined(rows)
    data = _FOLD[data]
    same = data[1:] == data[:-1]
    drop = np.zeros(len(data), bool)
    drop[1:] = same & (data[1:] == 32)
    # A byte goes if as many as REPEAT before it are the same: each step doubles what it has seen.
    seen = 1
    while seen < REPEAT and len(same) > seen:
        same, seen = same[seen:] & same[:-seen], 2 * seen
    if seen >= REPEAT:
        drop[REPEAT:] |= same
    drop[begins[1:] - 1] = False
    kept = len(data) - np.count_nonzero(drop)
    if kept == len(data):
        return data, begins, drop
    gone = np.concatenate(([0], np.cumsum(np.add.reduceat(drop, begins[:-1], dtype=np.int64)))) if len(rows) else begins
    return data[~drop], begins - gone, drop


def _grams(data: np.ndarray) -> np.ndarray:
    """The q-gram that begins at each byte, as a number; the last ``Q - 1`` bytes begin none."""
    gram = np.zeros(max(0, len(data) - Q + 1), np.uint64)
    for k in range(Q):
        gram = (gram << np.uint64(8)) | data[k : len(data) - Q + 1 + k].astype(np.uint64)
    return gram


class Items:
    """The folded items of one block, their windows, and where their q-grams are."""

    def __init__(self, ids: list, rows: list[bytes]):
        folded, begins, _ = _folded(rows)
        kept = [(i, folded[a : b - 1]) for i, a, b in zip(ids, begins[:-1], begins[1:], strict=True)]
        kept = [(i, b[b[:1].tobytes() == b" " : len(b) - (b[-1:].tobytes() == b" ")]) for i, b in kept]
        kept = [(i, b) for i, b in kept if len(b)]
        self.ids, self.bytes = [i for i, _ in kept], [b for _, b in kept]
        sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.short = [k for k, n in enumerate(sizes) if n < Q]
        self.windows = np.maximum(0, sizes - WINDOW) // STRIDE + 1
        self.first = np.cumsum(self.windows) - self.windows
        owner = np.repeat(np.arange(len(sizes)), self.windows)
        nth = np.arange(len(owner)) - self.first[owner]
        self.begin = nth * STRIDE
        self.end = np.where(nth == self.windows[owner] - 1, sizes[owner], self.begin + WINDOW)
        size = self.end - self.begin
        self.budget = np.minimum((size * EDITS).astype(np.int64), np.maximum(0, size - Q) // Q)
        grams = [_grams(b) if len(b) >= Q else np.zeros(0, np.uint64) for b in self.bytes]
        counts = np.array([len(g) for g in grams], np.int64)
        gram = np.concatenate([np.zeros(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(grams)), counts)
        at = np.concatenate([np.zeros(0, np.int64), *[np.arange(n) for n in counts]]).astype(np.int64)
        pairs = np.unique(np.stack([gram, item.astype(np.uint64)], axis=1), axis=0)[:, 0]
        values, holders = np.unique(pairs, return_counts=True)
        common = holders[np.searchsorted(values, gram)] > COMMON if len(gram) else np.zeros(0, bool)
        common |= gram == (gram & np.uint64(255)) * np.uint64(0x0101010101010101)
        # Grams of a window, and those that are not common, from sums up to each gram of its item.
        offset = np.cumsum(counts) - counts
        rare_up_to = np.concatenate(([0], np.cumsum(~common)))
        low, high = offset[owner] + self.begin, offset[owner] + np.maximum(self.begin, self.end - Q + 1)
        low, high = np.minimum(low, len(gram)), np.minimum(high, len(gram))
        rare, whole = rare_up_to[high] - rare_up_to[low], high - low
        # Half of the bound on all grams has to remain in each window, so that few regions pass by chance.
        enough = rare - Q * self.budget >= np.maximum(1, (whole - Q * self.budget) / 2)
        fewer = np.ones(len(sizes), bool)
        np.logical_and.at(fewer, owner, enough)
        self.bound = np.where(fewer[owner], rare, whole) - Q * self.budget
        take = ~(common & fewer[item])
        order = np.argsort(gram[take], kind="stable")
        self.gram, self.item, self.at = gram[take][order], item[take][order], at[take][order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.gram)] = True

    @staticmethod
    def _slot(gram: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of every shared gram."""
        gram = _grams(data)
        place = np.flatnonzero(self.filter[self._slot(gram)])
        first = np.searchsorted(self.gram, gram[place])
        n = np.searchsorted(self.gram, gram[place], side="right") - first
        place, first, n = place[n > 0], first[n > 0], n[n > 0]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(place, n), self.item[at], self.at[at]


def edits(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int]:
    """Fewest edits between the whole item and a stretch of the region, and where that stretch ends.

    Column ``k`` of row ``i`` is the cell (``i`` bytes of the item, ``i + k - most`` bytes of the region): the band
    of diagonals that a stretch within the budget can't leave.
    """
    width = len(region) - len(item) + 2 * most + 1
    far = len(item) + len(region) + 1
    step = np.arange(width)
    cost = np.where((step - most >= 0) & (step - most <= len(region)), 0, far)
    padded = np.concatenate([np.full(most + 1, 256, np.int16), region.astype(np.int16), np.full(width + most + 1, 256, np.int16)])
    for i in range(1, len(item) + 1):
        end = i + step - most
        here = padded[i : i + width] != item[i - 1]
        new = cost + here
        new[:-1] = np.minimum(new[:-1], cost[1:] + 1)
        new = np.where((end >= 0) & (end <= len(region)), new, far)
        cost = np.minimum.accumulate(new - step) + step
        cost = np.where((end >= 0) & (end <= len(region)), cost, far)
    best = int(cost.argmin())
    return int(cost[best]), len(item) + best - most


def _reaching(keys: np.ndarray, counts: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Which bands have, together with the band after them, as many grams as the bound says."""
    follows = np.zeros(len(keys), np.int64)
    near = np.flatnonzero(keys[1:] == keys[:-1] + 1)
    follows[near] = counts[near + 1]
    return counts + follows >= bound


def matches(items: Items, rows: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, edits, byte where the stretch ends) for each row and item that match, the best stretch of each."""
    data, begins, drop = _folded(rows)
    starts = np.concatenate(([0], np.cumsum([len(r) + 1 for r in rows])))
    best: dict[tuple[int, int], tuple[int, int]] = {}

    def found(row: int, item: int, cost: int, end: int) -> None:
        # Ends are told in the text as it was.
        end = int(np.flatnonzero(~drop[starts[row] : starts[row + 1]])[end - 1]) + 1
        best[row, item] = min(best.get((row, item), (cost, end)), (cost, end))

    for item in items.short:
        word = items.bytes[item].tobytes()
        for row in range(len(rows)):
            at = data[begins[row] : begins[row + 1] - 1].tobytes().find(word)
            if at >= 0:
                found(row, item, 0, at + len(word))
    place, item, at = items.hits(data)
    row = np.searchsorted(begins, place, side="right") - 1
    inside = place + Q < begins[row + 1]
    place, item, at, row = place[inside], item[inside], at[inside], row[inside]
    # Each hit counts for all windows that have its gram.
    last = np.minimum(at // STRIDE, items.windows[item] - 1)
    first = np.minimum(np.maximum(0, -((WINDOW - Q - at) // STRIDE)), items.windows[item] - 1)
    n = last - first + 1
    nth = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    place, at, row, item = (np.repeat(x, n) for x in (place, at, row, item))
    window = items.first[item] + nth
    # Bands are one budget wide and looked at in pairs, so that any stretch lies in one pair.
    wide = items.budget[window] + 1
    band = (place - begins[row] - at + len(data)) // wide
    shift = np.int64(2 * len(data) + 2)
    key = (row.astype(np.int64) * len(items.begin) + window) * shift + band
    # All hits are an upper bound of the count; where they reach the bound, a gram at one place of the item counts once in a band.
    keys, counts = np.unique(key, return_counts=True)
    likely = _reaching(keys, counts, items.bound[keys // shift % len(items.begin)]) if len(keys) else np.zeros(0, bool)
    likely[1:] |= likely[:-1] & (keys[1:] == keys[:-1] + 1)
    some = likely[np.searchsorted(keys, key)]
    once = np.unique(np.stack([key[some], at[some]], axis=1), axis=0)[:, 0] if some.any() else key[:0]
    keys, counts = np.unique(once, return_counts=True)
    group = keys // shift
    good = _reaching(keys, counts, items.bound[group % len(items.begin)]) if len(keys) else np.zeros(0, bool)
    owner = np.repeat(np.arange(len(items.bytes)), items.windows)
    for k in np.flatnonzero(good):
        r, window = divmod(int(group[k]), len(items.begin))
        which, budget = int(owner[window]), int(items.budget[window])
        if best.get((r, which), (1, 0))[0] == 0:
            continue
        word = items.bytes[which][items.begin[window] : items.end[window]]
        # Places on a diagonal are those of the window's own first byte.
        diagonal = int(keys[k] % shift) * (budget + 1) - len(data) + int(items.begin[window])
        text = data[begins[r] : begins[r + 1] - 1]
        begin = max(0, diagonal - budget)
        region = text[begin : max(begin, diagonal + 2 * (budget + 1) + len(word) + budget)]
        exact = region.tobytes().find(word.tobytes())
        cost, end = (0, exact + len(word)) if exact >= 0 else edits(word, region, budget) if len(region) >= len(word) - budget else (budget + 1, 0)
        if cost <= budget:
            found(r, which, cost, begin + end)
    for (r, which), (cost, end) in sorted(best.items()):
        yield r, which, cost, end


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """The benchmark in blocks of about ``limit`` bytes, each small enough to be handed to every task, one at a time."""
    benchmark = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where("text IS NOT NULL")
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = size // limit + 1
    for part in range(parts):
        rows = benchmark.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()
        yield [r["id"] for r in rows], [r["text"].encode() for r in rows]


def _search(items_of, emit, text: str = "text", limit: int = PIECE_BYTES):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = items_of.value
        items = Items(ids, rows)
        for piece in pieces(batches, text, limit):
            found = matches(items, texts(piece.column(piece.schema.get_field_index(text)))) if items.ids else iter(())
            yield emit(piece, items, list(found))

    return work


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item: str = "text"
) -> DataFrame:
    """``(doc_id, text_hash, item_id, edits, end_byte)``: every row of ``docs`` and item that match, once each."""
    spark = docs.sparkSession
    kinds = [docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()]
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    arrow = to_arrow_type(benchmark.schema[item_id].dataType)

    def emit(piece: pa.RecordBatch, items: Items, found: list) -> pa.RecordBatch:
        at = pa.array([f[0] for f in found], pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                piece.column(0).take(at),
                piece.column(2).take(at),
                pa.array([items.ids[f[1]] for f in found], arrow),
                pa.array([f[2] for f in found], pa.int32()),
                pa.array([f[3] for f in found], pa.int32()),
            ],
            ["doc_id", "text_hash", "item_id", "edits", "end_byte"],
        )

    schema = f"doc_id {kinds[0]}, text_hash long, item_id {kinds[1]}, edits int, end_byte int"
    found = [map_batches(named, _search(spark.sparkContext.broadcast(b), emit), schema) for b in blocks(benchmark, item_id, item)]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that match no item."""
    spark = docs.sparkSession

    def emit(piece: pa.RecordBatch, items: Items, found: list) -> pa.RecordBatch:
        keep = np.ones(piece.num_rows, bool)
        keep[[f[0] for f in found]] = False
        return piece.filter(pa.array(keep))

    for block in blocks(benchmark, item_id, item):
        docs = map_batches(docs, _search(spark.sparkContext.broadcast(block), emit, text, STAGE_BYTES), docs.schema)
    return docs


def contaminated_documents(spark, sf_dir: str) -> DataFrame:
    """op8: documents that hold an item of the benchmark, with the item and the edits."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return contaminated(docs, benchmark).drop("text_hash")
