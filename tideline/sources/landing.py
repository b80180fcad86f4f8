"""SC1, SC3, SC8: change rows of many tables landed as one log with a position index beside it.

Layout: ``<path>/rows/batch=<id>/part-….parquet`` (``LANDED_COLUMNS``) and ``<path>/index/batch=<id>/`` (one row for each
file and captured table: lowest and highest position, rows, rows with a command id). A batch counts once its index is
written, which comes last; landing a batch again replaces it. A range read asks the index for the files that
overlap and opens no others, however the files lie; catalogue and low watermarks come from the index alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tideline.model import CapturedTable
from tideline.operators.extents import lsn_extent
from tideline.session import remove
from tideline.sources.change_tables import LANDED_COLUMNS, ChangeSource, LandedLog, landed_all

_ROWS = "capture_instance string, start_lsn string, seqval string, command_id int, operation int, key string, image string"
_INDEX = (
    "file string, capture_instance string, min_lsn string, max_lsn string, change_rows bigint, "
    "rows_with_command_id bigint, batch string"
)


def land(sources: Iterable[ChangeSource], path: str, batch: str) -> DataFrame:
    """Land a batch of change rows of many tables; returns its part of the index."""
    return land_rows(landed_all(sources), path, batch)


def land_rows(rows: DataFrame, path: str, batch: str, cluster: bool = True) -> DataFrame:
    """The same for rows in landed form. With ``cluster``, files hold ranges of tables and positions, so few overlap."""
    spark = rows.sparkSession
    target, index = f"{path}/rows/batch={batch}", f"{path}/index/batch={batch}"
    # An earlier attempt must not be visible while its files are replaced.
    remove(spark, index)
    rows = rows.select(*LANDED_COLUMNS)
    order = ["capture_instance", "start_lsn"]
    rows = rows.repartitionByRange(*order) if cluster else rows
    rows.sortWithinPartitions(*order).write.mode("overwrite").parquet(target)
    written = spark.read.schema(_ROWS).parquet(target).select("*", F.col("_metadata.file_path").alias("file"))
    one, with_id = F.lit(1).cast("bigint"), F.col("command_id").isNotNull().cast("bigint")
    found = lsn_extent(written, ["file", "capture_instance"], change_rows=one, rows_with_command_id=with_id)
    found.write.mode("overwrite").parquet(index)
    return read_index(spark, path).where(F.col("batch") == batch)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The position index of all landed batches; none if nothing was landed."""
    try:
        return spark.read.schema(_INDEX).parquet(f"{path}/index")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], _INDEX)
        raise


def overlapping(index: DataFrame, low: str, high: str, instances: Sequence[str] = ()) -> DataFrame:
    """Index rows whose positions meet a range of positions."""
    found = index.where((F.col("max_lsn") >= low) & (F.col("min_lsn") <= high))
    return found.where(F.col("capture_instance").isin(list(instances))) if instances else found


def read_range(spark: SparkSession, path: str, low: str, high: str, instances: Sequence[str] = ()) -> DataFrame:
    """PF2, SC1: landed rows of a range of positions, from the files that hold some of it.

    The names of those files come to the driver, as they do for any scan that lists them.
    """
    found = overlapping(read_index(spark, path), low, high, instances).select("file").distinct().collect()
    files = sorted(r["file"] for r in found)
    if not files:
        return spark.createDataFrame([], _ROWS)
    rows = spark.read.schema(_ROWS).parquet(*files).where(F.col("start_lsn").between(low, high))
    return rows.where(F.col("capture_instance").isin(list(instances))) if instances else rows


def landed_catalog(spark: SparkSession, path: str) -> DataFrame:
    """SC3, SC9: what ``reports.capture_catalog`` says of the rows, from the index alone."""
    return read_index(spark, path).groupBy("capture_instance").agg(
        F.min("min_lsn").alias("min_lsn"),
        F.max("max_lsn").alias("max_lsn"),
        F.sum("change_rows").alias("change_rows"),
        F.sum("rows_with_command_id").alias("rows_with_command_id"),
    )


def landed_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """SC8: the lowest position of each table, from the index alone."""
    return landed_catalog(spark, path).select("capture_instance", "min_lsn")


def open_log(
    spark: SparkSession,
    path: str,
    tables: Sequence[CapturedTable],
    low: str = "0" * 20,
    high: str = "F" * 20,
    current: Mapping[str, DataFrame] | None = None,
) -> LandedLog:
    """What was landed as the source of a run; a known range keeps it from listing files that it won't read."""
    return LandedLog(tuple(tables), read_range(spark, path, low, high), dict(current or {}), landed_catalog(spark, path))
