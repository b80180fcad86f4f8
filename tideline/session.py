"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SHARED: dict[str, str] = {}
# The scopes open in this thread of work; another thread, such as a stream's, has its own.
_OPEN_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("tideline_scopes", default=())

# Above this many rows a helper table is joined by shuffle instead of being broadcast.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="tideline-")
    return _LOCAL_SHARED[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/tideline/{label}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, label: str) -> DataFrame:
    """Write ``rows`` once as a shared table and read it back.

    The result has no lineage to recompute, so values that depend on how rows were laid out (partition
    number, position in it) stay the same when an executor is lost, and the readers prune columns.
    """
    spark = rows.sparkSession
    path = new_path(spark, label)
    for scope in _OPEN_SCOPES.get():
        scope.append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends; nothing may read them afterwards."""
    paths: list[str] = []
    token = _OPEN_SCOPES.set((*_OPEN_SCOPES.get(), paths))
    try:
        yield
    finally:
        _OPEN_SCOPES.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own making, if it exists, on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The ``n`` of all folders ``…=n`` directly below a folder, none if it does not exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.split("=", 1)[-1].isdigit() and "=" in n)


def levels_of_first_file(spark: SparkSession, path: str) -> list[str] | None:
    """The ``name`` of all folders ``name=…`` above one data file below a folder; None if the folder does not exist.

    Lists one folder of each level, not the whole tree, unless folders without files come first.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return None

    def first(folder, names: list[str]) -> list[str] | None:
        for status in system.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(("_", ".")) and "=" not in name:
                continue
            if not status.isDirectory():
                return names
            found = first(status.getPath(), [*names, name.split("=", 1)[0]] if "=" in name else names)
            if found is not None:
                return found
        return None

    return first(root, []) or []


def small_side(rows: DataFrame, label: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Stage a helper table and broadcast it only when its counted rows are within ``limit``."""
    table = stage(rows, label)
    return F.broadcast(table) if table.count() <= limit else table
