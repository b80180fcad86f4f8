"""BPE with word ends through a lexicon of frequent words: encoding and decoding as the tokenizers library does it.

The most frequent words of the corpus are merged once and compiled into a minimal acyclic transducer: an automaton
over the bytes of the words in which equal suffixes are shared, with a number on each arc. The numbers along a path
add up to the word's place in the sorted lexicon, and a table gives its ids. Each worker writes the automaton as a
dense table to a file of its own and maps it into memory; all words of a piece of text walk it together, one byte a
step, in numpy. Words outside the lexicon are merged one by one, exactly, pair of least rank first; a bounded table
remembers them.

Words are cut as the vocabulary file says: special tokens first, wherever they stand; then NFC, lower case and the
pattern. Texts with characters from U+0180 on leave normalising and cutting to the library itself; below that, NFC
changes nothing and lower case maps character by character.

Null text counts as empty and gives no ids. Every row gets a row, whether it repeats or not, and an empty table an
empty result. Only the named columns are read or, in ``encoded``, kept as they are.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tideline.llm.batches import STAGE_BYTES, map_batches, pieces, texts
from tideline.session import stage

VOCABULARY = "word_bpe_49k.json"

LEXICON_WORDS = 100_000
#: So many of the most frequent words are compiled; the rest is merged when met.

LEXICON_BYTES = 64
#: Longer words are never compiled.

REMEMBERED = 200_000
#: Merged words a worker remembers before it starts anew.

COUNTED = 500_000
#: Distinct words a task counts before it hands its counts on.


class Scheme:
    """What the vocabulary file says: ids, merges, special tokens and how text is cut into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.path = path
        self.ids: dict[str, int] = dict(told["model"]["vocab"])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in told["model"]["merges"]]
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        self.end = told["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.names = {i: t for t, i in {**self.ids, **self.special}.items()}
        pattern = next(p["pattern"]["Regex"] for p in told["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # Below U+0180 the classes of the pattern are short enough to be written out, which the plain matcher is faster at.
        low = [chr(c) for c in range(0x180)]
        letters, numbers, space = (re.escape("".join(c for c in low if regex.match(k, c))) for k in (r"\p{L}", r"\p{N}", r"\s"))
        written = pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers).replace(r"\s", space)
        self.pattern = re.compile(written)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        # The letters that stand for bytes: printable Latin-1 for itself, the others from U+0100 on, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.letters = [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]

    @cached_property
    def library(self) -> Tokenizer:
        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    def words(self, row: bytes) -> list[str]:
        """The words of a text; special tokens are words of their own."""
        text = row.decode()
        if "<|" not in text or not self.cut.search(text):
            return self._plain(text, row)
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            out.extend([part] if k % 2 else self._plain(part, part.encode()))
        return out

    def _plain(self, text: str, row: bytes) -> list[str]:
        if not row or np.frombuffer(row, np.uint8).max() < 0xC6:
            return self.pattern.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        back = {c: b for b, c in enumerate(self.letters)}
        return [bytes(back[c] for c in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def merged(self, word: str) -> list[int]:
        """Ids of one word: the pair of least rank is joined again and again, from left to right."""
        if word in self.special:
            return [self.special[word]]
        parts = [self.letters[b] for b in word.encode()]
        parts[-1] += self.end
        parts = [p for p in parts if p in self.ids]
        while len(parts) > 1:
            ranks = [self.rank.get(pair, len(self.rank)) for pair in zip(parts, parts[1:], strict=False)]
            least = min(ranks)
            if least == len(self.rank):
                break
            left, right = parts[at := ranks.index(least)], parts[at + 1]
            out, k = parts[:at], at
            while k < len(parts):
                if k + 1 < len(parts) and parts[k] == left and parts[k + 1] == right:
                    out.append(left + right)
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return [self.ids[p] for p in parts]

    def decoded(self, ids: list[int]) -> str:
        """The names of the ids with a blank between, as the library decodes where the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids))


def compiled(words: list[bytes]) -> dict[str, np.ndarray]:
    """The minimal acyclic automaton of sorted, distinct words, as arcs in the order of their states.

    Words are added in order; once a branch can't change any more, each of its states is replaced by an equal one met
    before. States count the words below them, from which the numbers on the arcs follow.
    """
    register: dict[tuple, int] = {}
    final: list[bool] = []
    arcs: list[list[tuple[int, int]]] = []

    def settled(ends: bool, out: list[tuple[int, int]]) -> int:
        key = (ends, tuple(out))
        if key not in register:
            register[key] = len(final)
            final.append(ends)
            arcs.append(out)
        return register[key]

    open_ends, open_arcs, before = [False], [[]], b""

    def close(depth: int) -> None:
        while len(open_arcs) > depth + 1:
            out, ends = open_arcs.pop(), open_ends.pop()
            open_arcs[-1].append((before[len(open_arcs) - 1], settled(ends, out)))

    for word in words:
        shared = len(os.path.commonprefix([before, word]))
        close(shared)
        for _ in range(len(word) - shared):
            open_arcs.append([])
            open_ends.append(False)
        open_ends[-1] = True
        before = word
    close(0)
    root = settled(open_ends[0], open_arcs[0])
    below = np.zeros(len(final), np.int64)
    source, label, target, add = [], [], [], []
    for state, out in enumerate(arcs):  # a state is settled after those it leads to
        number = int(final[state])
        for byte, to in out:
            source.append(state)
            label.append(byte)
            target.append(to)
            add.append(number)
            number += below[to]
        below[state] = number
    return {
        "source": np.array(source, np.int32),
        "label": np.array(label, np.uint8),
        "target": np.array(target, np.int32),
        "add": np.array(add, np.int32),
        "final": np.array(final),
        "root": np.array([root]),
    }


class Automaton:
    """The automaton as a dense table in a mapped file: one row a state, one column a byte that occurs."""

    def __init__(self, arcs: dict[str, np.ndarray]):
        used = np.unique(arcs["label"])
        self.column = np.full(256, len(used), np.int64)
        self.column[used] = np.arange(len(used))
        self.width, self.final, self.root = len(used) + 1, arcs["final"], int(arcs["root"][0])
        size = len(self.final) * self.width * 4
        # The file has no name any more once it is mapped; it goes with the worker.
        with tempfile.TemporaryFile() as file:
            file.truncate(2 * size)
            self._map = mmap.mmap(file.fileno(), 2 * size)
        self.next = np.frombuffer(self._map, np.int32, size // 4)
        self.add = np.frombuffer(self._map, np.int32, size // 4, size)
        self.next[:] = -1
        cell = arcs["source"].astype(np.int64) * self.width + self.column[arcs["label"]]
        self.next[cell], self.add[cell] = arcs["target"], arcs["add"]

    def places(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place in the lexicon of each span of bytes, -1 where it is not in it."""
        out = np.full(len(begin), -1, np.int64)
        walking = np.arange(len(begin))
        at, state, number = begin.copy(), np.full(len(begin), self.root), np.zeros(len(begin), np.int64)
        while len(walking):
            done = at >= end[walking]
            ended = done & self.final[state]
            out[walking[ended]] = number[ended]
            walking, at, state, number = walking[~done], at[~done], state[~done], number[~done]
            cell = state * self.width + self.column[data[at]]
            number = number + self.add[cell]
            state, at = self.next[cell].astype(np.int64), at + 1
            alive = state >= 0
            walking, at, state, number = walking[alive], at[alive], state[alive], number[alive]
        return out


class Encoder:
    """A worker's encoder: the mapped lexicon, and exact merges for all other words."""

    def __init__(self, path: str, lexicon: dict[str, np.ndarray]):
        self.scheme = Scheme(path)
        self.automaton = Automaton(lexicon)
        self.ids, self.begins = lexicon["ids"], lexicon["begins"]
        self.memory: dict[str, list[int]] = {}

    def _merged(self, word: str) -> list[int]:
        if word not in self.memory:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[word] = self.scheme.merged(word)
        return self.memory[word]

    def encode(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin (one more entry: the end)."""
        words: list[str] = []
        sizes = np.zeros(len(rows) + 1, np.int64)
        for k, row in enumerate(rows):
            words.extend(self.scheme.words(row))
            sizes[k + 1] = len(words)
        data = np.frombuffer("\n".join(words).encode() + b"\n", np.uint8) if words else np.zeros(0, np.uint8)
        end = np.flatnonzero(data == 10)
        begin = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
        place = self.automaton.places(data, begin, end)
        unknown = np.flatnonzero(place < 0)
        merged = [self._merged(words[k]) for k in unknown]
        extra = np.array([i for ids in merged for i in ids], np.uint32)
        length = np.zeros(len(words), np.int64)
        first = np.zeros(len(words), np.int64)
        known = place >= 0
        first[known] = self.begins[place[known]]
        length[known] = self.begins[place[known] + 1] - first[known]
        length[unknown] = [len(ids) for ids in merged]
        first[unknown] = len(self.ids) + np.cumsum(length[unknown]) - length[unknown]
        start = np.concatenate(([0], np.cumsum(length)))
        source = np.repeat(first - start[:-1], length) + np.arange(start[-1])
        return np.concatenate((self.ids, extra))[source], start[sizes]


def _counted(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme, seen = Scheme(path), Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for piece in pieces(batches):
            for row in texts(piece.column(0)):
                seen.update(scheme.words(row))
            if len(seen) > COUNTED:
                yield told()
                seen.clear()
        yield told()

    return count


def lexicon(docs: DataFrame, path: str, text: str = "text", words: int = LEXICON_WORDS) -> dict[str, np.ndarray]:
    """The automaton of the most frequent words of all texts, ``words`` at most, with their ids."""
    counts = map_batches(docs.select(F.col(text).alias("text")), _counted(path), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stage(counts.where(F.octet_length("word") <= LEXICON_BYTES), "word-counts")
    # Words by sixteenths of an octave of their count: a table of a few hundred rows tells which count leaves few
    # enough words above it, and only those come to the driver.
    octave = F.floor(F.log2("n") * 16).cast("int")
    above, least = 0, 1 << 30
    for step, count in sorted(counts.groupBy(octave.alias("step")).count().collect(), reverse=True):
        above += count
        if above > words:
            break
        least = step
    scheme = Scheme(path)
    listed = sorted(r["word"].encode() for r in counts.where(octave >= least).collect() if r["word"] not in scheme.special)
    ids = [scheme.merged(w.decode()) for w in listed]
    begins = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int64)
    return {**compiled(listed), "ids": np.array([i for x in ids for i in x], np.uint32), "begins": begins}


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str, told: dict[str, np.ndarray]) -> Encoder:
    """One encoder for all tasks of a worker that use the same lexicon."""
    digest = hashlib.sha256(path.encode() + b"".join(v.tobytes() for v in told.values())).hexdigest()
    if digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[digest] = Encoder(path, told)
    return _ENCODERS[digest]


def encoded(docs: DataFrame, path: str | None = None, text: str = "text", told: dict | None = None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with ``ids`` (array<int>) after them; an earlier ``ids`` is replaced."""
    docs = docs.drop("ids")
    path = path or public_tokenizers.path(VOCABULARY)
    sent = docs.sparkSession.sparkContext.broadcast(told or lexicon(docs, path, text))
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, sent.value)
        for piece in pieces(batches, text, STAGE_BYTES):
            ids, begins = encoder.encode(texts(piece.column(at)))
            lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([*piece.columns, lists], [*piece.schema.names, "ids"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_batches(docs, work, f"{schema}, ids array<int>")


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the text of their ids; null ids count as none, an earlier ``decoded`` is replaced."""
    rows = rows.drop("decoded")
    path = path or public_tokenizers.path(VOCABULARY)
    at = rows.columns.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = Scheme(path)
        for batch in batches:
            told = [scheme.decoded(x or []) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(told, pa.string())], [*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return map_batches(rows, work, f"{schema}, decoded string")


def digests(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass; return counts and digests instead of the ids and texts themselves."""
    path = path or public_tokenizers.path(VOCABULARY)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon(docs, path, text))
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, sent.value)
        for piece in pieces(batches):
            ids, begins = encoder.encode(texts(piece.column(1)))
            raw = memoryview(ids.astype("<u4").tobytes())
            listed = ids.tolist()
            spans = list(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array(np.diff(begins)),
                    pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in spans], pa.string()),
                    pa.array([hashlib.sha256(encoder.scheme.decoded(listed[a:b]).encode()).hexdigest() for a, b in spans], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(named, work, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded_documents(spark, sf_dir: str) -> DataFrame:
    """op1: ids of every document and the text they decode to, as digests."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
