"""Token ids in files: canonical Huffman codes of limited length, each document a block that decodes on its own.

Texts are encoded with the tokenizers library; a table of units met before spares it the same work again. Units are
stretches of text between places where the library's own split (that of byte-level vocabularies) ends a piece whatever
stands around: see ``cuts``. So units can be encoded alone. Texts that hold special tokens are encoded whole.

Ids of all documents are counted, package-merge gives the best code lengths of at most ``LONGEST`` bits, and equal
lengths are numbered in order of id, so the lengths are all a reader needs. A block has the codes of a document
without gaps and the bit offset of every ``EVERY``-th id; a decoder looks ``LONGEST`` bits up in one table and works
on all stretches between offsets at once.

On disk: ``codes`` (id, length) and ``blocks`` (doc_id, n_tokens, offsets, payload), both Parquet, the blocks in
ascending order of doc_id over the files, nulls first. Every document ends with the id ``END``.

Null text counts as empty: one id, the end. Rows that repeat an id follow each other, those with equal texts in any
order. Each row gets a row; an empty table gives empty files. Columns besides id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm.batches import STAGE_BYTES, map_batches, pieces, texts
from tideline.session import new_path, small_side, stage

VOCABULARY = "byte_bpe_50k.json"
END = 0

LONGEST = 20
EVERY = 1024

REMEMBERED = 1_000_000
#: Units of text a worker remembers at most, but for those of the texts at hand.

OTHER, LETTER, DIGIT, MARK, LINE, BLANK, BORDER = range(7)
#: Kinds of bytes. White space besides blank and line feed, and characters beyond Latin-1 letters, are of the first.

_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = MARK
_KIND[[k for k in range(128) if chr(k).isalpha()]] = LETTER
_KIND[48:58] = DIGIT
_KIND[10], _KIND[32], _KIND[255] = LINE, BLANK, BORDER
_IS_WORD, _IS_SPACE = np.isin(np.arange(7), (LETTER, DIGIT, MARK)), np.isin(np.arange(7), (LINE, BLANK))
_LATIN = np.zeros(256, bool)
_LATIN[[k for k in range(0x80, 0xC0) if chr(k + 0x40).isalpha()]] = True
# The last two are white space by older tables; a place less to cut does no harm.
_WHITE = [chr(k).encode() for k in (*(k for k in range(1 << 16) if chr(k).isspace()), 0x180E, 0x200B)]
_WHITE_OF = [np.array([int.from_bytes(w, "little") for w in _WHITE if len(w) == n], np.int64) for n in (1, 2, 3)]


def _before_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character behind each place is white space."""
    code = sum(data[np.minimum(at + n, len(data) - 1)].astype(np.int64) << (8 * n - 8) for n in (1, 2, 3))
    return np.any([np.isin(code & ((1 << 8 * n) - 1), white) for n, white in enumerate(_WHITE_OF, 1)], axis=0)


def cuts(data: np.ndarray) -> np.ndarray:
    """Begins of units in texts that each end with a byte 255.

    The library's split takes runs of letters, of digits and of marks, each with one blank before it, English endings
    after an apostrophe, and white space, of which the last one before anything else stands apart. It looks at nothing
    behind it, so a unit may begin wherever a piece of it always does: at white space after a word, at the last white
    space before one, after a line feed, and where the kind changes, but not after an apostrophe.
    """
    kind = _KIND[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[_LATIN[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = LETTER
    word, space = _IS_WORD[kind], _IS_SPACE[kind]
    cut = np.ones(len(data), bool)
    after, at = kind[:-1], kind[1:]
    changes = word[1:] & (after != at) & (data[:-1] != 39)
    cut[1:] = (word[:-1] & (changes | space[1:])) | ((after == LINE) & word[1:]) | (after == BORDER) | (at == BORDER)
    cut[1:-1] |= space[1:-1] & word[2:]
    blanks = np.flatnonzero((at[:-1] == BLANK) & (kind[2:] == OTHER)) + 1
    cut[blanks] |= ~_before_white(data, blanks)
    return np.flatnonzero(cut)


def _strung(ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Stretches of ids one after the other."""
    ends = np.cumsum(count)
    return ids[np.repeat(begin - (ends - count), count) + np.arange(int(count.sum()))]


class Encoder:
    """The library, and a table of the ids of units met before."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        # A token of a byte-level vocabulary is written with one letter a byte.
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self._remember([], np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _remember(self, units: list[bytes], ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> None:
        """These units and nothing else; the border of texts has no ids."""
        self.known = {unit: k for k, unit in enumerate([b"\xff", *units])}
        self.ids, self.begin, self.count = ids, np.append(0, begin), np.append(0, count)

    def alone(self, text: str) -> np.ndarray:
        # The fast form leaves out offsets, which nothing here reads.
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, units: list[bytes]) -> None:
        """Encode units in one go, those without a leading blank after a line feed; their ends are those of tokens."""
        blank, bare, odd = [], [], []
        for unit in units:
            text = unit.decode()
            inner = text.strip()
            # A line feed beside other white space would be one piece with it.
            (odd if not inner else bare if text == inner else blank if text == " " + inner else odd).append(unit)
        text = b"".join(blank) + b"".join([b"\n" + unit for unit in bare])
        ids = self.alone(text.decode())
        size = np.array([len(unit) for unit in blank + bare], np.int64)
        ends = np.cumsum(size + (np.arange(len(size)) >= len(blank)))
        token_ends = np.cumsum(self.bytes[ids])
        begin = np.searchsorted(token_ends, ends - size, side="right")
        count = np.searchsorted(token_ends, ends, side="right") - begin
        others = [self.alone(unit.decode()) for unit in odd]
        more = np.array([len(i) for i in others], np.int64)
        begin = np.concatenate((begin, len(ids) + np.cumsum(more) - more)) + len(self.ids)
        self.known.update(zip(blank + bare + odd, range(len(self.begin), len(self.begin) + len(begin)), strict=True))
        self.ids = np.concatenate((self.ids, ids, *others))
        self.begin, self.count = np.concatenate((self.begin, begin)), np.concatenate((self.count, count, more))

    def _places(self, units: list[bytes]) -> np.ndarray:
        """Places of units in the table, after those not met before have been learned."""
        found = [*map(self.known.get, units)]
        unknown = [unit for unit, k in zip(units, found, strict=True) if k is None]
        if not unknown:
            return np.array(found, np.int64)
        if len(self.known) + len(unknown) > REMEMBERED:
            kept = [(unit, k) for unit, k in zip(units, found, strict=True) if k]
            at = np.array([k for _, k in kept], np.int64)
            count = self.count[at]
            self._remember([unit for unit, _ in kept], _strung(self.ids, self.begin[at], count), np.cumsum(count) - count, count)
        self._learn(unknown)
        return np.array([*map(self.known.__getitem__, units)], np.int64)

    def encode(self, rows: list[bytes]) -> list[bytes]:
        """Ids of each text as bytes (32-bit, little-endian)."""
        whole = {k: row for k, row in enumerate(rows) if any(token in row for token in self.special)}
        data = np.frombuffer(b"".join([b"\xff" if k in whole else row + b"\xff" for k, row in enumerate(rows)]), np.uint8)
        begins = cuts(data)
        offsets = np.append(begins, len(data)).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        at = self._places(units.dictionary.to_numpy(zero_copy_only=False).tolist())[units.indices.to_numpy()]
        count = self.count[at]
        raw = _strung(self.ids, self.begin[at], count).astype("<u4").tobytes()
        ends = 4 * np.cumsum(count)[data[begins] == 255]
        out = [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        for k, row in whole.items():
            out[k] = self.alone(row.decode()).astype("<u4").tobytes()
        return out


_ENCODERS: dict[str, Encoder] = {}


def _tokenized(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(path, Encoder(path)) if path not in _ENCODERS else _ENCODERS[path]
        end = np.array([END], "<u4").tobytes()
        for piece in pieces(batches):
            ids = [_narrow(row + end) for row in encoder.encode(texts(piece.column(1)))]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return work


def _narrow(ids: bytes) -> bytes:
    """Ids on 16 bits with a leading zero byte where they all fit, else as they are with a leading one."""
    wide = np.frombuffer(ids, "<u4")
    return b"\0" + wide.astype("<u2").tobytes() if wide.max() < 1 << 16 else b"\1" + ids


def _wide(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4" if ids[0] else "<u2", offset=1).astype(np.uint32)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for piece in pieces(batches, "ids", STAGE_BYTES):
        seen = np.bincount(np.concatenate([_wide(ids) for ids in piece.column(0).to_pylist()]))
        if len(seen) > len(total):
            total = np.concatenate((total, np.zeros(len(seen) - len(total), np.int64)))
        total[: len(seen)] += seen
    there = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["id", "n"])


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code with at most ``longest`` bits, by package-merge; ``counts`` are positive."""
    n = len(counts)
    if n > 1 << longest:
        raise ValueError(f"{n} ids need codes of more than {longest} bits")
    if n <= 1:
        return np.ones(n, np.uint8)
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    packages, leaves = np.zeros(0), []
    for _ in range(longest):
        together = np.concatenate((weights, packages))
        by = np.argsort(together, kind="stable")
        leaves.append(by < n)
        together = together[by]
        half = len(together) // 2
        packages = together[0 : 2 * half : 2] + together[1 : 2 * half : 2]
    lengths, take = np.zeros(n, np.uint8), 2 * n - 2
    for leaf in reversed(leaves):
        own = int(leaf[:take].sum())
        lengths[order[:own]] += 1
        take = 2 * (take - own)
    return lengths


class Code:
    """Canonical codes from lengths: shorter codes come first, equal lengths in order of id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, lengths = ids[order].astype(np.uint32), lengths[order].astype(np.int64)
        room = np.int64(1) << (LONGEST - lengths)
        first = np.cumsum(room) - room
        size = int(ids.max()) + 1 if len(ids) else 1
        self.code, self.length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[self.ids] = (first >> (LONGEST - lengths)).astype(np.uint64)
        self.length[self.ids] = lengths
        # Each entry has an id and, in its last five bits, the length. Bits beyond the codes, which only broken input
        # has, stay id 0 of one bit.
        self.found = np.ones(1 << LONGEST, np.uint64 if size > 1 << 27 else np.uint32)
        self.found[: room.sum()] = np.repeat((self.ids.astype(np.uint64) << np.uint64(5)) | lengths.astype(np.uint64), room)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload of a block and the bit offsets of its stretches."""
        return self.encode_rows([ids])[0]

    def encode_rows(self, rows: list[np.ndarray]) -> list[tuple[bytes, np.ndarray]]:
        """The same for a block of each row, all in one go; a block begins at a whole word."""
        ids = np.concatenate(rows)
        size = np.array([len(row) for row in rows])
        last = np.cumsum(size)
        length = self.length[ids]
        start = np.cumsum(length) - length
        begin = start[last - size]
        bits = start[last - 1] + length[last - 1] - begin
        word_of = np.cumsum((bits + 63) >> 6) - ((bits + 63) >> 6)
        start += np.repeat((word_of << 6) - begin, size)
        code = self.code[ids]
        words = np.zeros(int(((bits + 63) >> 6).sum()) + 1, np.uint64)
        word, shift = start >> 6, 64 - (start & 63) - length
        high = np.where(shift >= 0, code << np.maximum(shift, 0).astype(np.uint64), code >> np.maximum(-shift, 0).astype(np.uint64))
        cut = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        words[word[cut]] = np.bitwise_or.reduceat(high, cut)
        over = np.flatnonzero(shift < 0)
        words[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        raw = words.astype(">u8").tobytes()
        return [
            (raw[8 * w : 8 * w + (n + 7) // 8], start[a:b:EVERY] - 64 * w)
            for w, n, a, b in zip(word_of.tolist(), bits.tolist(), (last - size).tolist(), last.tolist(), strict=True)
        ]

    def decode(self, payloads: list[bytes], offsets: list[np.ndarray], sizes: list[int]) -> np.ndarray:
        """Ids of all blocks one after the other: every stretch takes one step at a time, all of them together."""
        padded = [p + bytes(16 + -len(p) % 8) for p in payloads]
        words = np.frombuffer(b"".join(padded), ">u8").astype(np.uint64)
        begin = np.cumsum([0, *[len(p) * 8 for p in padded]])[:-1]
        at = np.concatenate([o + b for o, b in zip(offsets, begin, strict=True)])
        left = np.concatenate([np.minimum(EVERY, n - EVERY * np.arange(len(o))) for o, n in zip(offsets, sizes, strict=True)])
        to = np.cumsum(left) - left
        out = np.zeros(int(left.sum()), self.found.dtype)
        lanes = np.argsort(-left, kind="stable")
        at, to, left = at[lanes], to[lanes], left[lanes]
        for turn in range(int(left[0]) if len(left) else 0):
            here = int(np.searchsorted(-left, -turn, side="left"))
            at, to = at[:here], to[:here]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            window = words[word] << bit | words[word + 1] >> np.uint64(1) >> (np.uint64(63) - bit)
            key = (window >> np.uint64(64 - LONGEST)).astype(np.int64)
            entry = self.found[key]
            out[to + turn] = entry
            at = at + (entry & 31).astype(np.int64)
        return (out >> 5).astype(np.uint32)


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all texts and write them below ``path``."""
    spark = docs.sparkSession
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    kind = docs.schema[doc_id].dataType.simpleString()
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = new_path(spark, "ids")
    map_batches(named, _tokenized(vocabulary), f"doc_id {kind}, ids binary").write.option("compression", "zstd").parquet(held)
    ids = spark.read.parquet(held)
    # One row for each id of the vocabulary at most.
    counts = map_batches(ids.select("ids"), _counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    symbols, lengths = counts.column("id").to_numpy(), code_lengths(counts.column("n").to_numpy())
    spark.createDataFrame(pa.table({"id": pa.array(symbols, pa.int64()), "length": pa.array(lengths, pa.int32())})).write.parquet(f"{path}/codes")
    sent = spark.sparkContext.broadcast((symbols, lengths))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(*sent.value)
        for piece in pieces(batches, "ids", STAGE_BYTES):
            rows = [_wide(x) for x in piece.column(1).to_pylist()]
            blocks = code.encode_rows(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([b[1] for b in blocks], pa.list_(pa.int64())),
                    pa.array([b[0] for b in blocks], pa.binary()),
                ],
                ["doc_id", "n_tokens", "offsets", "payload"],
            )

    # Sorted before they are coded, so that finding the ranges reads ids and hashes only. The hash splits a range of
    # many rows with one id, such as null.
    hashed = ids.select("doc_id", "ids", F.xxhash64("ids").alias("place"))
    ordered = hashed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "ids")
    ordered = map_batches(ordered, coded, f"doc_id {kind}, n_tokens long, offsets array<bigint>, payload binary")
    ordered = ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    ordered.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _read(spark: SparkSession, path: str, schema: str, emit) -> DataFrame:
    codes = spark.read.parquet(f"{path}/codes").toArrow()
    sent = spark.sparkContext.broadcast((codes.column("id").to_numpy(), codes.column("length").to_numpy()))
    blocks = spark.read.parquet(f"{path}/blocks").select("doc_id", "part", "at", "n_tokens", "offsets", "payload")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(*sent.value)
        for piece in pieces(batches, "payload"):
            sizes = piece.column(3).to_pylist()
            offsets = [np.array(o, np.int64) for o in piece.column(4).to_pylist()]
            ids = code.decode(piece.column(5).to_pylist(), offsets, sizes)
            yield emit(piece, ids, np.cumsum([0, *sizes]))

    return map_batches(blocks, work, f"doc_id {blocks.schema['doc_id'].dataType.simpleString()}, {schema}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, ids)`` of every block below ``path``."""

    def emit(piece: pa.RecordBatch, ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view(np.int32)))
        return pa.RecordBatch.from_arrays([piece.column(0), lists], ["doc_id", "ids"])

    return _read(spark, path, "ids array<int>", emit)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every block below ``path``."""

    def emit(piece: pa.RecordBatch, ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        raw = memoryview(ids.astype("<u4").tobytes())
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [*piece.columns[:3], pa.array(np.diff(ends), pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "part", "at", "n_tokens", "ids_crc32"]
        )

    rows = stage(_read(spark, path, "part int, at long, n_tokens long, ids_crc32 long", emit), "read-back")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row for each file's partition; all of them in one window is what a prefix sum over them takes.
    before = F.coalesce(F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = small_side(parts.select("part", before.alias("before")), "parts")
    inside = W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
    return rows.select("doc_id", (F.col("before") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def ids_of_documents(spark, sf_dir: str) -> DataFrame:
    """op4: every document encoded, written and read back."""
    path = new_path(spark, "token-files")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_digests(spark, path)
