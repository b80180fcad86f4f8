"""SK6: the manifest, written last.

A run may write very many windows, so the list of files is a table of its own (``manifests/files``), one folder a
run; the run itself is one row (``manifests/runs``) that names that folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tideline.functions.lsn import to_text

FILE_FIELDS = ("capture_instance", "source_schema", "source_table", "from_lsn", "to_lsn", "records_written", "path")
_RUNS = (
    "run_id string, database_name string, max_lsn string, mode string, started_at string, finished_at string, "
    "total_records bigint, files_written bigint, committed_bookmarks map<string,string>, "
    "files_path string"
)


def run_row(files: DataFrame, bookmarks: DataFrame, **facts: str) -> DataFrame:
    """One row: run facts, totals and bookmarks."""
    totals = files.agg(
        F.coalesce(F.sum("records_written"), F.lit(0)).alias("total_records"),
        F.count(F.lit(1)).alias("files_written"),
    )
    entries = F.array_sort(F.collect_list(F.struct("capture_instance", to_text(F.col("lsn")).alias("lsn"))))
    marks = bookmarks.agg(F.map_from_entries(entries).alias("committed_bookmarks"))
    # Both sides are single rows.
    return totals.crossJoin(marks).select(*[F.lit(v).alias(k) for k, v in facts.items()], *totals.columns, *marks.columns)


def write_manifest(files: DataFrame, bookmarks: DataFrame, path: str, run_id: str, **facts: str) -> DataFrame:
    """Write the file list, then the run row; with it the run becomes visible. Returns the run row."""
    spark = files.sparkSession
    listing = files_folder(path, run_id)
    files.select(*FILE_FIELDS).write.mode("overwrite").json(listing)
    written = spark.read.schema(files.select(*FILE_FIELDS).schema).json(listing)
    row = run_row(written, bookmarks, run_id=run_id, files_path=f"manifests/files/run_id={run_id}", **facts)
    row.coalesce(1).write.mode("overwrite").json(run_folder(path, run_id))
    return read_run(spark, path, run_id)


def run_folder(path: str, run_id: str) -> str:
    return f"{path}/manifests/runs/run={run_id}"


def files_folder(path: str, run_id: str) -> str:
    return f"{path}/manifests/files/run_id={run_id}"


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The row of one run, none if it was not published. Reads that run's folder only."""
    try:
        return spark.read.schema(_RUNS).json(run_folder(path, run_id))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], _RUNS)
        raise


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs with a manifest."""
    try:
        return spark.read.schema(_RUNS).json(f"{path}/manifests/runs")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], _RUNS)
        raise


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of all runs; run ids stay text, whatever they look like."""
    schema = "capture_instance string, source_schema string, source_table string, from_lsn string, to_lsn string, "
    return spark.read.schema(schema + "records_written bigint, path string, run_id string").json(f"{path}/manifests/files")
