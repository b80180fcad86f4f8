"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

**Signature.** A shingle that occurs ``w`` times has weight ``w``. The weights are discretised in whole steps, and the
steps are cut into the ranges [0,1), [1,2), [2,4), [4,8) and so on. Each (shingle, range) has a Poisson process of
its own whose rate is the width of the range times the number of signature components. Its points come in order of
time; each point names a component and, by halving the range again and again, a step; it counts if that step is below
``w``. A component of a signature is the earliest point that counts. Two documents agree in a component with
probability sum(min)/sum(max) of their weights, the weighted Jaccard similarity. Points later than the expected end of
a document are not made at all, which leaves about one point per shingle beyond the first few hundred; documents with
an open component are gone over again with a later end.

**Candidates.** Signatures are cut into bands; contents that share a band meet in a bucket. All rows with the same
words are one content, so copies meet nowhere. Contents that share no band with any other are done. A passage that
many contents hold brings contents together that are not alike otherwise, so the others are dealt again to buckets by
their rarest shingles: of two sets as alike as asked for, the rarest members always have one in common, and its place
bounds the overlap. In a bucket no pairs are made: each round a leader is compared with every other member that is not
yet in its component, and is then taken out. Buckets whose members are all in one component are finished; in the others
the number of leaders grows from round to round, so the rounds are few. A pair is left out only if a chain of verified
links already joins it, or if its bound is too low.

**Verification.** The exact multiset overlap of the candidates' shingles decides.

Words are runs without ASCII white space, with A-Z lower-cased. A text of one to four words has one shingle, all its
words. Null text counts as empty; all texts without a word are copies of each other. Null ids are allowed, repeated
rows are copies, an empty table gives an empty result, and columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.batches import joined, lowered, map_batches, mix, pieces, span_hashes, texts, word_spans
from tideline.llm.graph import components
from tideline.session import small_side, stage

WORDS = 5
SIMILARITY = 0.8

BANDS, ROWS = 30, 5
#: At a similarity of 0.8 a pair shares no band with probability (1 - 0.8**5)**30, less than 1 in 100,000.

SKETCHED_BYTES = 1_000_000
#: Text sketched at once; a signature needs about a thousand points while it is made, however short its text.

LEADERS_GROW = 8
#: Leaders of a bucket in the first round: one; in each later round so many times more.

_LATE = 3.0
#: How far past the expected last component points are made at first, in expected points per component.


def shingles(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and 64-bit hash of every shingle, and two hashes of each row's words, in one array per row."""
    data, begins = joined(rows)
    data = lowered(data)
    first, last = word_spans(data)
    owner = np.searchsorted(begins, first, side="right") - 1
    words = span_hashes(data, first, last)
    n = np.bincount(owner, minlength=len(rows))
    start = np.concatenate(([0], np.cumsum(n)))[:-1]
    place = (np.arange(len(words)) - np.repeat(start, n)).astype(np.uint64)
    content = np.zeros((len(rows), 2), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(2):
            np.add.at(content[:, k], owner, mix(words ^ mix(place + np.uint64((k + 1) << 40))))
        content = mix(content + n[:, None].astype(np.uint64))
        width = np.minimum(np.maximum(n, 1), WORDS)
        begin = np.flatnonzero(place.astype(np.int64) + width[owner] <= n[owner])
        value = np.zeros(len(begin), np.uint64)
        for k in range(WORDS):
            inside = k < width[owner[begin]]
            at = np.minimum(begin + k, len(words) - 1)
            value += np.where(inside, mix(words[at] + np.uint64(k + 1)), np.uint64(0))
        return owner[begin], mix(value), content


def weighted(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, shingle) with the number of times it occurs, by owner and shingle."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))[: len(owner)])
    return owner[new], value[new], np.diff(np.concatenate((new, [len(owner)])))


def signatures(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, size: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures, one row of ``size`` numbers for each of ``rows`` owners; zeros where there is no shingle."""
    signature = np.zeros((rows, size), np.uint64)
    total = np.bincount(owner, weights=weight, minlength=rows)
    # Points per component that are looked at; the earliest of them stand whatever comes later.
    reach = np.full(rows, np.log(size) + _LATE)
    todo = total > 0
    ranges = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    element = np.repeat(np.arange(len(owner)), ranges)
    level = np.arange(len(element)) - np.repeat(np.cumsum(ranges) - ranges, ranges)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.maximum(low, 1)
    process = mix(value[element] + mix(level.astype(np.uint64)))
    while todo.any():
        best = np.full(rows * size, np.inf)
        mine = np.flatnonzero(todo[owner[element]])
        time, point = np.zeros(len(mine)), 0
        end = (reach / np.maximum(total, 1))[owner[element[mine]]]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(mine):
            point += 1
            with np.errstate(over="ignore"):
                here = mix(process[mine] + np.uint64(point) * np.uint64(0x9E3779B97F4A7C15))
                which = mix(here + np.uint64(1))
            uniform = ((here >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
            time = time - np.log(uniform) / (size * width[mine])
            alive = time <= end
            mine, time, end, here, which = mine[alive], time[alive], end[alive], here[alive], which[alive]
            slot = owner[element[mine]] * size + ((which >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
            # The low bits are the halvings of the range, the first one the highest.
            step = low[mine] + (which & (width[mine] - 1).astype(np.uint64)).astype(np.int64)
            counts = step < weight[element[mine]]
            np.minimum.at(best, slot[counts], time[counts])
            found.append((slot[counts], time[counts], here[counts]))
        slot, time, here = (np.concatenate(x) for x in zip(*found, strict=True))
        first = time == best[slot]
        flat = signature.reshape(-1)
        flat[slot[first]] = here[first]
        todo &= np.isinf(best).reshape(rows, size).any(axis=1)
        reach[todo] *= 2
    return signature


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One number for each band of each signature; equal only within the same band."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.zeros((len(signature), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            out += mix(parts[:, :, k] + np.uint64(k + 1))
        return mix(out + mix(np.arange(BANDS, dtype=np.uint64)))


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "__text", SKETCHED_BYTES):
        rows = texts(piece.column(piece.num_columns - 1))
        owner, value, content = shingles(rows)
        element, distinct, weight = weighted(owner, value)
        bands = band_hashes(signatures(element, distinct, weight, len(rows)))
        n = np.bincount(owner, minlength=len(rows))
        # The k-th occurrence of a shingle is a member of its own, so that overlaps of multisets are those of sets; 32
        # bits tell the members of two documents apart well enough.
        turn = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
        with np.errstate(over="ignore"):
            members = (mix(np.repeat(distinct, weight) + mix(turn.astype(np.uint64))) >> np.uint64(32)).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [
                *piece.columns[:-1],
                pa.array(content[:, 0].view(np.int64)),
                pa.array(content[:, 1].view(np.int64)),
                _lists(bands.reshape(-1).view(np.int64), np.arange(1, len(rows) + 1) * BANDS),
                _lists(members.view(np.int32), np.cumsum(n)),
            ],
            ["doc_id", "text_hash", "c0", "c1", "bands", "items"],
        )


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets whose repeated members are numbered."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = len(np.intersect1d(a, b))
    return shared / (len(a) + len(b) - shared)


def _verified(least: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = [
                similarity(left[k].values.to_numpy(zero_copy_only=False), right[k].values.to_numpy(zero_copy_only=False)) >= least
                for k in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row, doc_id, text_hash, c0, c1, bands, items)`` of every row, written once; ``c0, c1`` stand for its words."""
    kind = docs.schema[doc_id].dataType.simpleString()
    named = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.col(text).alias("__text"))
    schema = f"doc_id {kind}, text_hash long, c0 long, c1 long, bands array<long>, items array<int>"
    return stage(map_batches(named, _sketched, schema).withColumn("row", F.monotonically_increasing_id()), "sketches")


def _open(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    spread = members.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    return stage(members.join(spread.where("least <> most").select("bucket"), "bucket"), "members")


def _shared(entries: DataFrame) -> DataFrame:
    """``entries (bucket, node)`` of buckets with more than one content, with their size, written once."""
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return stage(entries.join(sizes, "bucket"), "met")


def _rarest(all_items: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """``(bucket, node, n, left)``: a bucket for each of the rarest shingles of the ``nodes``.

    Two sets of similarity ``least`` have one of their ``n - ceil(least * n) + 1`` rarest members in common, if both
    are sorted the same way, so nothing is lost. Shingles of one node only count, but need no bucket.
    """
    held = all_items.join(small_side(nodes, "met-nodes"), "node")
    held = stage(held.select("node", F.size("items").alias("n"), F.explode("items").alias("item")), "held")
    common = stage(held.groupBy("item").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"), "common")
    by_node = held.join(common, "item").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("holders", "item"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    # The small part taken off keeps the bound whole where the product is, but for rounding, a whole number.
    take = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1 - alone
    rarest = F.slice("shared", F.lit(1), F.greatest(take, F.lit(0)).cast("int"))
    placed = by_node.select(F.posexplode(rarest).alias("at", "s"), "node", "n", alone.alias("alone"))
    placed = placed.select(
        F.xxhash64(F.lit("item"), "s.item").alias("bucket"), "node", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left")
    )
    # From its place in a bucket on a node has ``left`` members; they have to do for the shortest it meets there.
    shortest = placed.groupBy("bucket").agg(F.min("n").alias("shortest"))
    other = F.greatest(F.ceil(F.col("n") * least - 1e-9), "shortest")
    return placed.join(shortest, "bucket").where(F.col("left") >= (F.col("n") + other) * (least / (1 + least)) - 1e-9).drop("shortest")


def linked(entries: DataFrame, all_items: DataFrame, least: float = SIMILARITY) -> DataFrame | None:
    """``(node, label)`` of all contents with a near duplicate; None if no two contents share a bucket.

    ``entries (bucket, node)`` are the buckets of each content, without repeats; ``all_items (node, items)`` holds their shingles.
    """
    met = _shared(entries)
    # A band of a passage that many contents hold brings contents together that are not alike otherwise. Those that
    # met any other meet again by their rarest shingles, which misses no pair and leaves few to compare.
    met = _shared(_rarest(all_items, met.select("node").distinct(), least))
    # Contents that meet many others are likely close to all of a group, so they lead.
    degree = met.groupBy("node").agg(F.sum("size").alias("degree"))
    members = _open(met.drop("size").join(degree, "node").withColumn("label", F.col("node")))
    items = links = labels = None
    leaders_each = 1
    while members.head(1):
        # One leader for each of ``leaders_each`` slots that the members of a bucket are dealt to.
        slot = F.pmod(F.xxhash64("node", F.lit(leaders_each)), F.lit(leaders_each)).alias("slot")
        best = F.max(F.struct("degree", "node", "label", "n", "left")).alias("best")
        leaders = members.groupBy("bucket", slot).agg(best)
        told = [F.col(f"best.{c}").alias(f"its_{c}") for c in ("label", "n", "left")]
        leaders = stage(leaders.select("bucket", F.col("best.node").alias("leader"), *told), "leaders")
        enough = F.least("left", "its_left") >= (F.col("n") + F.col("its_n")) * (least / (1 + least)) - 1e-9
        met = members.join(leaders, "bucket").where((F.col("label") != F.col("its_label")) & enough)
        pairs = stage(met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct(), "pairs")
        if items is None:
            wanted = small_side(members.select("node").distinct(), "wanted")
            items = stage(all_items.join(wanted, "node"), "items")
        both = pairs.join(items.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(
            items.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"
        )
        new = map_batches(both.select("a", "b", "x", "y"), _verified(least), "a long, b long")
        links = stage(new if links is None else links.union(new), "links")
        labels = components(links)
        rest = members.drop("label").join(leaders.select("bucket", F.col("leader").alias("node")), ["bucket", "node"], "left_anti")
        members = _open(rest.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
        leaders_each *= LEADERS_GROW
    return labels


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``(doc_id, text_hash, class_id, label)`` of every row, written once.

    ``class_id`` is the least id in the class (null only if all its ids are null), ``label`` names the class.
    """
    rows = sketches(docs, doc_id, text)
    nodes = stage(rows.groupBy("c0", "c1").agg(F.min("row").alias("node")), "nodes")
    own = rows.where(F.size("items") > 0).select(F.col("row").alias("node"), "bands").join(nodes.select("node"), "node")
    entries = own.select(F.explode("bands").alias("bucket"), "node")
    labels = linked(entries, rows.select(F.col("row").alias("node"), "items"), least)
    named = nodes.withColumn("label", F.col("node"))
    if labels is not None:
        named = nodes.join(labels, "node", "left").select("c0", "c1", F.coalesce("label", "node").alias("label"))
    named = stage(named.select("c0", "c1", "label"), "named")
    placed = stage(rows.select("doc_id", "text_hash", "c0", "c1").join(named, ["c0", "c1"]).drop("c0", "c1"), "placed")
    heads = stage(placed.groupBy("label").agg(F.min("doc_id").alias("class_id")), "heads")
    return stage(placed.join(heads, "label").select("doc_id", "text_hash", "class_id", "label"), "classes")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stand for their class; of rows that repeat id and text, one."""
    found = classes(docs, doc_id, text, least)
    # Several rows may carry the least id; the one with the least hash of its text stands for them.
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    chosen = stage(heads.groupBy("label").agg(F.min("text_hash").alias("first_hash")), "chosen")
    marked = found.join(chosen, "label")
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("first_hash"))
    name = (F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    dropped = small_side(marked.where(~first).select(*name).distinct(), "dropped")
    repeated = marked.where(first).groupBy(*name).count().where("count > 1").drop("count")
    repeated = small_side(repeated, "repeated")

    def same(rows: DataFrame, other: DataFrame):
        return rows[doc_id].eqNullSafe(other["__id"]) & (F.xxhash64(F.coalesce(rows[text], F.lit(""))) == other["__hash"])

    kept = docs.join(dropped, same(docs, dropped), "left_anti")
    if not repeated.head(1):
        return kept
    copies = kept.join(repeated, same(kept, repeated), "left_semi").dropDuplicates([doc_id, text])
    return kept.join(repeated, same(kept, repeated), "left_anti").union(copies)


def near_duplicates_of_documents(spark, sf_dir: str) -> DataFrame:
    """op7: the class of every document."""
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id")
