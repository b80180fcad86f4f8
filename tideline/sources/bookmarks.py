"""SC10, SK7: bookmarks as a versioned table; the newest complete version counts.

A version is written by the one writer that has claimed its number: the claim is a file created only if it is absent. Whoever
comes second waits for that version and puts its own marks on top of it, or refuses if both moved a table.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tideline.errors import BookmarkConflict
from tideline.functions.lsn import parse, to_text
from tideline.operators.resume import merge_bookmarks
from tideline.session import stage

_STORED = "capture_instance string, lsn string, entries bigint, version bigint"
_BOOKMARKS = "capture_instance string, lsn string"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_STORED).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], _STORED)
        raise


def _newest_version(spark: SparkSession, path: str) -> int | None:
    """A version is complete when it holds as many rows as each of its rows says."""
    complete = (
        _versions(spark, path)
        .groupBy("version")
        .agg(F.count(F.lit(1)).alias("found"), F.max("entries").alias("entries"))
        .where("found = entries")
    )
    return complete.agg(F.max("version")).first()[0]


def newest_version(spark: SparkSession, path: str) -> int:
    """The number of the version in force, 0 if there is none."""
    return _newest_version(spark, path) or 0


def load_bookmarks(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Bookmarks in canonical form, of the version in force or of a known one; an absent store is an empty one."""
    version = newest_version(spark, path) if version is None else version
    if not version:
        return spark.createDataFrame([], _BOOKMARKS)
    stored = _versions(spark, path).where(F.col("version") == version)
    return stored.select("capture_instance", parse(F.col("lsn")).alias("lsn"))


def save_bookmarks(bookmarks: DataFrame, path: str, base: int | None = None, patience: float = 60.0) -> int:
    """Write the next version beside the others, so a failed write leaves the last one in force.

    ``base`` is the version that the marks build on, by default the one in force. If others have written since, their
    marks stay for tables that this save does not move; a table that both moved raises ``BookmarkConflict``. So does a claimed
    version that is not finished within ``patience`` seconds: if its writer has died, remove its claim.
    """
    spark = bookmarks.sparkSession
    bookmarks = stage(bookmarks, "bookmarks")  # one row per captured table
    known = newest_version(spark, path)
    if base is not None and base != known:
        bookmarks = _rebased(bookmarks, path, base, known)
    version = known + 1
    while not _claimed(spark, path, version):
        until = time.monotonic() + patience
        while newest_version(spark, path) < version:
            if time.monotonic() > until:
                raise BookmarkConflict(f"version {version} is claimed but not written: {_claim(path, version)}")
            time.sleep(min(0.2, patience))
        bookmarks = _rebased(bookmarks, path, version - 1, version)
        version += 1
    entries = bookmarks.count()
    stored = bookmarks.select("capture_instance", to_text(F.col("lsn")).alias("lsn"), F.lit(entries).alias("entries"))
    # Overwriting can only replace remains that nobody has claimed.
    stored.coalesce(1).write.mode("overwrite").json(f"{path}/version={version}")
    return version


def _claim(path: str, version: int) -> str:
    return f"{path}/_claims/{version}"


def _claimed(spark: SparkSession, path: str, version: int) -> bool:
    """Create the claim of a version unless there is one; true for the one writer that created it."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_claim(path, version))
    system = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = system.create(file, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or system.exists(file):
            return False
        raise
    out.writeBytes(uuid.uuid4().hex)
    out.close()
    return True


def _rebased(mine: DataFrame, path: str, base: int, newest: int) -> DataFrame:
    """Marks that build on version ``base`` on top of a later one."""
    spark = mine.sparkSession
    old, now = (load_bookmarks(spark, path, n) for n in (base, newest))
    before = old.select("capture_instance", F.col("lsn").alias("old"))
    theirs = now.join(before, "capture_instance", "left").where("NOT lsn <=> old")
    ours = mine.join(before, "capture_instance", "left").where("NOT lsn <=> old")
    both = theirs.join(ours, "capture_instance", "left_semi").orderBy("capture_instance").limit(20).collect()
    if both:
        raise BookmarkConflict("another run has moved the bookmarks of: " + ", ".join(r["capture_instance"] for r in both))
    return stage(merge_bookmarks(now, ours.select("capture_instance", "lsn")), "rebased-bookmarks")


def read_bookmark_document(spark: SparkSession, path: str) -> DataFrame:
    """Bookmarks kept as one document: ``{"capture_instances": {name: "0x…"}}``."""
    document = spark.read.schema("capture_instances map<string,string>").option("multiLine", "true").json(path)
    return document.select(F.explode("capture_instances").alias("capture_instance", "lsn")).select(
        "capture_instance", parse(F.col("lsn")).alias("lsn")
    )


def bookmark_document(bookmarks: DataFrame) -> DataFrame:
    """The same document from bookmarks (one entry per captured table), names sorted."""
    entries = F.array_sort(F.collect_list(F.struct("capture_instance", to_text(F.col("lsn")).alias("lsn"))))
    named = F.struct(F.map_from_entries(entries).alias("capture_instances"))
    return bookmarks.agg(F.to_json(named).alias("value"))
