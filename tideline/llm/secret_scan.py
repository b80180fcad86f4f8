"""Secrets in texts, told apart from widely copied examples by how many owners hold them. DataFrame functions only.

**Base spans.** Three patterns, each matched from left to right without overlap: assignments of a password, token or
key; access key ids; long runs of lower-case hexadecimal digits. A match that is too short is dropped, and what it
covered is not looked at again. A base span is always reported.

**Ownership.** Besides these, any run of ``RUN`` or more token characters that has letters and digits is a candidate
(kind ``owned``) unless it overlaps a base span. The values of all candidates and base spans are hashed, and for each hash
the distinct repositories and owners in the whole corpus are counted, in steps that sum up before they shuffle, so a
value that a third of all rows hold costs no task more than others. A value held by more than ``OWNERS`` owners is a
copied example; others are live. Candidates are reported only if live; base spans are only counted as live or copied.

Positions are code points, ends exclusive. Null text counts as empty and has no spans; a null owner is one owner of
its own; the repository of a row is the hash of its text, so copies of a text count once an owner. Each row gets a
row, also if it repeats; an empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import small_side, stage

# The patterns of the three base kinds. Letters of the keyword stand in either case (ASCII only).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
VALUE = 6
#: Least length of an assigned value.

RUN = 20
OWNERS = 3

PIECE = 1024
#: Code points of a piece of a text that is masked.

KINDS = ("assign", "access", "hex", "owned")
MASK = "[secret]"

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,hash:bigint>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, though the body names it often."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, combine) -> Column:
    """``combine`` (a sum, a maximum) of each value of an array of at least one and all before it.

    An array that grows by one element is copied each time, so the array is cut into as many blocks as a block has
    elements; what a block hands on is added to the next ones afterwards.
    """
    none = F.array().cast("array<bigint>")
    last = lambda found: F.element_at(found, -1)
    grown = lambda found, x: F.array_append(found, F.when(F.size(found) > 0, combine(last(found), x)).otherwise(x))
    within = lambda block: F.aggregate(block, none, grown)

    def blocks(values: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(values))).cast("int")
        return F.transform(F.sequence(F.lit(1), F.size(values), size), lambda i: within(F.slice(values, i, size)))

    def joined(found: Column) -> Column:
        handed = within(F.transform(found, last))
        moved = lambda handed: F.transform(
            found, lambda block, i: F.when(i == 0, block).otherwise(F.transform(block, lambda x: combine(F.get(handed, i - 1), x)))
        )
        return F.flatten(_let(handed, moved))

    return _let(_let(values, blocks), joined)


def _found(text: Column, pattern: str, kind: int, value_from: int = 0, kept=None) -> Column:
    """Spans of all matches whose value is ``kept``: what lies between the matches gives their places."""
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_from)).alias("value"),
        F.split(text, pattern, -1).alias("gap"),
    )

    def placed(matches: Column) -> Column:
        steps = F.transform(matches, lambda m: (F.length(m["gap"]) + F.length(m["hit"])).cast("bigint"))
        span = lambda m, end: F.struct(
            (end - F.length(m["hit"])).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), F.xxhash64(m["value"]).alias("hash")
        )
        chosen = lambda m, end: F.when(kept(m["value"]), span(m, end)) if kept else span(m, end)
        return F.filter(F.zip_with(matches, _running(steps, lambda a, b: a + b), chosen), lambda s: s.isNotNull())

    # The text after the last match is a gap without a match.
    spans = _let(F.filter(zipped, lambda m: m["hit"].isNotNull()), placed)
    return F.when(text.rlike(pattern), spans).otherwise(F.from_json(F.lit("[]"), _SPAN))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind."""
    return F.array_sort(
        F.concat(
            _found(text, ASSIGN, "assign", 2, lambda value: F.length(value) >= VALUE),
            _found(text, ACCESS, "access"),
            _found(text, HEX, "hex"),
        )
    )


def candidate_spans(text: Column, base: Column) -> Column:
    """Runs of token characters with letters and digits that overlap no base span."""
    token = "[A-Za-z0-9_-]"
    # Most texts have no such run, which one look at the start of each run tells.
    likely = text.rlike(rf"(?<!{token})(?={token}{{{RUN}}})[A-Za-z_-]*+[0-9]")
    mixed = _found(text, rf"{token}{{{RUN},}}", "owned", kept=lambda value: value.rlike("[0-9]") & value.rlike("[A-Za-z]"))

    def free(spans: Column) -> Column:
        is_base = lambda s: s["kind"] < KINDS.index("owned")
        reach = _running(F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(F.lit(0).cast("bigint"))), F.greatest)
        # Runs never overlap each other, so what begins inside of one is a base span.
        apart = lambda s, i, reach: (F.get(reach, i) <= s["start"]) & (F.coalesce(F.get(spans, i + 1)["start"], s["end"]) >= s["end"])
        return _let(reach, lambda reach: F.filter(spans, lambda s, i: ~is_base(s) & apart(s, i, reach)))

    both = _let(F.array_sort(F.concat(base, mixed)), lambda spans: F.when(F.size(spans) > 0, free(spans)).otherwise(spans))
    return F.when(likely, both).otherwise(F.from_json(F.lit("[]"), _SPAN))


def _printed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def scanned(docs: DataFrame, doc_id: str, text: str, owner: str) -> DataFrame:
    """``(row, doc_id, owner, repository, base, more)`` of every row, written once."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), body.alias("text"))
    rows = rows.select("doc_id", "owner", F.xxhash64("text").alias("repository"), "text", base_spans(F.col("text")).alias("base"))
    rows = rows.withColumn("more", candidate_spans(F.col("text"), F.col("base"))).drop("text")
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "scanned")


def ownership(rows: DataFrame) -> DataFrame:
    """``(hash, owners, repositories)`` of every value in ``rows (base, more, owner, repository)``."""
    held = rows.select(F.explode(F.concat("base", "more")).alias("span"), "owner", "repository")
    held = held.select(F.col("span.hash").alias("hash"), "owner", "repository").distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", owners: int = OWNERS) -> DataFrame:
    """One row per document: counts per base kind, digest of the base spans, all spans, live and copied values."""
    rows = scanned(docs, doc_id, text, owner)
    known = stage(ownership(rows).where(F.col("owners") > owners).select("hash"), "copied-values")
    spans = rows.where(F.size("base") + F.size("more") > 0).select("row", F.explode(F.concat("base", "more")).alias("span"))
    judged = spans.withColumn("hash", F.col("span.hash")).join(known.withColumn("copied", F.lit(True)), "hash", "left")
    live = F.col("copied").isNull()
    kept = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(live | (F.col("span.kind") < KINDS.index("owned")), F.col("span")))).alias("spans"),
        F.count(F.when(live, 1)).alias("n_live"),
        F.count(F.col("copied")).alias("n_copied"),
    )
    none = rows.where(F.size("base") + F.size("more") == 0).select("row", "doc_id", "base", F.col("base").alias("spans"), F.lit(0).cast("bigint").alias("n_live"), F.lit(0).cast("bigint").alias("n_copied"))
    some = rows.where(F.size("base") + F.size("more") > 0).join(kept, "row").select("row", "doc_id", "base", "spans", "n_live", "n_copied")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return none.union(some).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_printed(F.col("base")), 256).alias("base_sha256"),
        _printed(F.col("spans")).alias("spans"),
        "n_live",
        "n_copied",
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or chain of overlapping spans, replaced by ``MASK``."""

    def rebuilt(spans: Column, pieces: Column, reach: Column) -> Column:
        def cut(begin: Column, end: Column) -> Column:
            first = F.floor(begin / PIECE).cast("int")
            some = F.slice(pieces, first + 1, F.floor((end - 1) / PIECE).cast("int") - first + 1)
            return F.when(begin < end, F.substring(F.array_join(some, ""), (begin - first * PIECE + 1).cast("int"), (end - begin).cast("int"))).otherwise("")

        before = lambda i: F.when(i > 0, F.get(reach, i - 1)).otherwise(F.lit(0).cast("bigint"))
        part = lambda s, at: F.when(s["start"] >= at, F.concat(cut(at, s["start"]), F.lit(MASK))).otherwise("")
        parts = F.transform(spans, lambda s, i: _let(before(i), lambda at: part(s, at)))
        tail = cut(F.element_at(reach, -1), F.length(text).cast("bigint"))
        return F.concat(F.array_join(parts, ""), tail)

    def done(spans: Column) -> Column:
        # A cut from a text is counted from its start, so cuts are made from pieces of the text.
        pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
        reach = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
        return _let(F.struct(pieces.alias("pieces"), reach.alias("reach")), lambda x: rebuilt(spans, x["pieces"], x["reach"]))

    return F.when(F.size(spans) > 0, _let(F.array_sort(spans), done)).otherwise(text)


def without_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", length: str = "n_chars", owners: int = OWNERS) -> DataFrame:
    """The rows of ``docs`` with base spans and live candidates masked in the text, and the length set anew where it changed."""
    names = docs.columns
    # Longer than any name of the table, so none of them can clash.
    mark = "_" * (1 + max(len(c) for c in names))
    id_, hash_, live_, spans_ = (mark + n for n in ("id", "hash", "live", "spans"))
    rows = scanned(docs, doc_id, text, owner)
    known = stage(ownership(rows).where(F.col("owners") > owners).select("hash"), "copied-values")
    more = rows.where(F.size("more") > 0).select("doc_id", "repository", F.explode("more").alias("span")).withColumn("hash", F.col("span.hash"))
    live = more.join(known, "hash", "left_anti").groupBy("doc_id", "repository").agg(F.collect_set("span").alias("live"))
    live = small_side(live.select(F.col("doc_id").alias(id_), F.col("repository").alias(hash_), F.col("live").alias(live_)), "live")
    body = F.coalesce(docs[text], F.lit(""))
    with_live = docs.join(live, docs[doc_id].eqNullSafe(live[id_]) & (F.xxhash64(body) == live[hash_]), "left")
    spans = F.concat(base_spans(docs[text]), F.coalesce(live[live_], F.from_json(F.lit("[]"), _SPAN)))
    marked = with_live.withColumn(spans_, F.when(docs[text].isNotNull(), spans))
    changed = F.size(spans_) > 0
    new = F.when(changed, masked(docs[text], F.col(spans_))).otherwise(docs[text])
    out = [
        new.alias(c) if c == text else F.when(changed, F.length(new)).otherwise(docs[c]).cast(docs.schema[c].dataType).alias(c) if c == length else docs[c]
        for c in names
    ]
    return marked.select(*out)


def secrets_of_documents(spark, sf_dir: str) -> DataFrame:
    """op5: secrets of every document; its source is the owner."""
    return secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
