"""Document fingerprints from closed syncmers. DataFrame functions only.

A text is a row of units. Each run of ``K`` units is looked at through its runs of ``S`` units: it is an anchor if
the least hash among them belongs to the first or the last. Whether a run is an anchor depends on the run alone, so
a passage has the same anchors wherever it stands, and no two neighbouring anchors lie far apart. The
fingerprint is the row of anchor hashes; likeness is the share of distinct anchors that two fingerprints have in common.

Units are single code points, in texts of every length, so that texts of different sizes and scripts can be compared. A
text of fewer than ``K`` code points has one anchor: all of it. Null and empty texts have none; two fingerprints without
anchors are alike.

Rows that repeat id and text are one document in the order of documents and each get its result. Null ids come last in
descending order. One document alone is its own neighbour. An empty table gives an empty result; columns besides id
and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.operators.skew import number_rows
from tideline.session import stage

K, S = 8, 2

TOGETHER = 32
#: Documents that follow each other and are dealt to one task; each such stretch has one text more sent to it.


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, though the body names it often."""
    return F.transform(F.array(value), body)[0]


def _runs(text: Column) -> Column:
    """``array<struct<at, anchor>>``: place and hash of the anchors among the runs of ``K`` units."""
    runs = K - S + 1

    def chosen(inner: Column) -> Column:
        def least(edge: Column, i: Column) -> Column:
            found = edge <= F.get(inner, i + 1)
            for k in range(2, runs - 1):
                found = found & (edge <= F.get(inner, i + k))
            return found

        # Comparisons that stop at the first that fails take less time than the least of all.
        at_edge = lambda i: least(F.get(inner, i), i) | least(F.get(inner, i + (runs - 1)), i)
        # Every S-th inner run tells all units of the run.
        whole = lambda i: F.struct(i.alias("at"), F.hash(*[F.get(inner, i + k) for k in range(0, runs, S)]).alias("anchor"))
        return F.transform(F.filter(F.sequence(F.lit(0), F.size(inner) - runs), at_edge), whole)

    def paired(units: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(units) - S), lambda i: F.xxhash64(*[F.get(units, i + k) for k in range(S)]))
        return _let(pairs, chosen)

    none = F.array().cast("array<struct<at:int,anchor:int>>")
    return F.when(F.length(text) < K, none).otherwise(_let(F.split(text, ""), paired))


def _whole(text: Column, found: Column) -> Column:
    """The anchors of a text whose runs are known."""
    short = F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(F.array(F.hash(text)))
    return F.when(F.length(text) < K, short).otherwise(found)


def anchors(text: Column) -> Column:
    """``array<int>`` of the anchor hashes of a text, in order of place."""
    return _whole(text, F.transform(_runs(text), lambda r: r["anchor"]))


def printed(found: Column) -> Column:
    """Anchors as text, eight hexadecimal digits each."""
    return F.array_join(F.transform(found, lambda a: F.lpad(F.hex(a.cast("bigint").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def likeness(shared: Column, a: Column, b: Column) -> Column:
    """Share of the distinct anchors of both that both have, 0 to 1, by the counts of the shared ones and of those of either."""
    return F.when(a + b == 0, 1.0).otherwise(shared / (a + b - shared))


def places(rows: DataFrame) -> DataFrame:
    """``(key, copies, place)`` for distinct ``rows (key, doc_id, text_hash)``, written once; places count from 1 in order of id."""
    distinct = rows.groupBy("key", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    return stage(number_rows(distinct, [], ["doc_id", "text_hash"], "place", unique=True).select("key", "copies", "place"), "places")


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited text, and how alike they and the next document's are."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_hash"))
    rows = rows.withColumn("key", F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex("text_hash")))
    order = places(rows.select("key", "doc_id", "text_hash"))
    most = order.agg(F.max("place")).first()[0] or 0
    full = rows.select("doc_id", "key", "text").join(order.hint("merge"), "key")
    repeated = bool(order.where("copies > 1").head(1))
    if repeated:
        full = full.dropDuplicates(["key"])
    # The next document in descending order of id is the one a place below. Neighbours are dealt together; the last of
    # a stretch is also sent to the stretch after it, and the last of all to the first, for their next document only.
    place = F.col("place")
    put = lambda stretch, at, own: F.struct(stretch.cast("long").alias("stretch"), at.cast("long").alias("at"), F.lit(own).alias("own"))
    after = F.when(place == most, put(F.lit(0), F.lit(0), False)).when(place % TOGETHER == 0, put(place / TOGETHER, place, False))
    dealt = F.filter(F.array(put(F.floor((place - 1) / TOGETHER), place, True), after), lambda x: x.isNotNull())
    dealt = full.select("doc_id", "text", "copies", F.explode(dealt).alias("put")).select("doc_id", "text", "copies", "put.*")
    # Sorted before the anchors are worked out, so that the sort moves texts only.
    dealt = dealt.repartition("stretch").sortWithinPartitions("stretch", "at").withColumn("runs", _runs(F.col("text")))
    dealt = dealt.select(
        "doc_id",
        "text",
        "copies",
        "stretch",
        "at",
        "own",
        F.transform("runs", lambda r: r["at"]).alias("begins"),
        _whole(F.col("text"), F.transform("runs", lambda r: r["anchor"])).alias("anchors"),
    ).withColumn("size", F.size(F.array_distinct("anchors")))
    below = W.partitionBy("stretch").orderBy("at")
    both = dealt.select("*", *[F.lag(name).over(below).alias(f"next_{name}") for name in ("doc_id", "text", "begins", "anchors", "size")])
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    both = both.where("own").select(
        "*",
        F.substring(F.col("text"), F.lit(1), n - third).alias("kept"),
        F.substring(F.col("next_text"), F.lit(1), third).alias("head"),
    )
    # The runs inside either part are known from the two texts; only those across the seam are new.
    kept, head = F.length("kept"), F.length("head")
    seam = F.concat(F.substring(F.col("kept"), F.greatest(kept - (K - 2), F.lit(1)), F.lit(K - 1)), F.substring("head", 1, K - 1))
    inside = lambda begins, size: _let(size - K, lambda last: F.size(F.filter(begins, lambda at: at <= last)))
    # Counts and prints that are named more than once are columns first, so that each is worked out once.
    both = both.select(
        "*",
        F.concat("kept", "head").alias("edited"),
        printed(F.col("anchors")).alias("fingerprint"),
        inside(F.col("begins"), kept).alias("n_kept"),
        F.concat(
            F.transform(_runs(seam), lambda r: r["anchor"]),
            F.slice("next_anchors", 1, inside(F.col("next_begins"), head)),
        ).alias("more"),
    )
    # An edited text of fewer than K units keeps no run.
    both = both.withColumn("more", _whole(F.col("edited"), F.col("more")))
    both = both.withColumn("edited_anchors", F.concat(F.slice("anchors", 1, F.col("n_kept")), F.col("more")))
    found = both.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        F.concat(F.substring(F.col("fingerprint"), F.lit(1), 8 * F.col("n_kept")), printed(F.col("more"))).alias("edited_fingerprint"),
        F.size(F.array_intersect("anchors", "edited_anchors")).alias("shared_edited"),
        F.size(F.array_distinct("edited_anchors")).alias("edited_size"),
        F.size(F.array_intersect("anchors", "next_anchors")).alias("shared_next"),
        "size",
        "next_size",
        "next_doc_id",
        "copies",
    )
    found = found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("shared_edited"), F.col("size"), F.col("edited_size")).alias("near_edited"),
        likeness(F.col("shared_next"), F.col("size"), F.col("next_size")).alias("near_next"),
        "next_doc_id",
        "copies",
    )
    if repeated:
        found = found.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return found.drop("copies")


def fingerprints_of_documents(spark, sf_dir: str) -> DataFrame:
    """op10: fingerprints of every document."""
    return fingerprinted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
