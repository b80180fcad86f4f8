"""SS3, SS5: pairing in a stream by commit time, with late rows as an output of their own.

The watermark after a batch is the newest commit time seen, less a delay. A batch first splits off its late rows, those at or
below the watermark that the batch before left: the transactions they belong to may be closed. They are stored and counted
for each batch. All other rows are held in the append-only store of ``TransactionSink`` until the watermark passes their commit
time; then their changes are paired. Rows without a commit time stay open.

Once a stream has stopped for good, ``flush`` closes what is open and pairs the late changes none of whose rows was closed
before. It reads the open segments and the late rows; of the closed changes it reads the keys in the range of positions
of the late rows, and nothing is shuffled for them as long as the late keys are few.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.model import CHANGE_KEY
from tideline.operators import changes
from tideline.session import small_side, stage, staging
from tideline.streaming.incremental import TransactionSink, Transform, up_to

_EVER = "F" * 20


class WatermarkSink(TransactionSink):
    """``foreachBatch`` target for change rows with ``commit_time``; ``transform`` pairs whole transactions.

    Besides the folders of ``TransactionSink``: ``late/batch_id=n`` (rows), ``closed/batch_id=n`` (keys of closed changes),
    ``marks/batch_id=n`` (one row: the newest commit time so far).
    """

    def __init__(self, path: str, transform: Transform, delay: timedelta, most_segments: int = 64) -> None:
        super().__init__(path, self._paired, lambda index: F.lit(False), most_segments)
        self.pair, self.delay, self._batch = transform, delay, 0

    def _facts(self) -> list[Column]:
        return [F.max("commit_time").alias("commit_time")]

    def _index_schema(self) -> str:
        return "start_lsn string, rows bigint, segments array<bigint>, commit_time timestamp"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staging(spark):
            batch = stage(batch.withColumn("commit_time", F.col("commit_time").cast("timestamp")), "batch")
            newest, mark = self._newest(spark, batch_id - 1), None
            late = F.lit(False)
            if newest is not None:
                mark = newest - self.delay
                late = F.coalesce(F.col("commit_time") <= F.lit(mark), F.lit(False))
            batch.where(late).write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}")
            seen = [t for t in (newest, batch.agg(F.max("commit_time")).first()[0]) if t is not None]
            newest = max(seen, default=None)
            self._close(batch.where(~late), batch_id, None if newest is None else newest - self.delay)
            spark.createDataFrame([(newest,)], "newest timestamp").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/batch_id={batch_id}")

    def _newest(self, spark: SparkSession, batch_id: int):
        if batch_id < 0:
            return None
        return spark.read.schema("newest timestamp").parquet(f"{self.path}/marks/batch_id={batch_id}").first()[0]

    def _close(self, rows: DataFrame, batch_id: int, mark) -> None:
        self._batch = batch_id
        done = F.lit(False) if mark is None else F.coalesce(F.col("commit_time") <= F.lit(mark), F.lit(False))
        # All rows of a transaction have its commit time, so rows and index agree on what is closed.
        self._handle(rows, batch_id, lambda index: done)

    def _paired(self, rows: DataFrame) -> DataFrame:
        keyed = changes.with_change_key(rows).groupBy(*CHANGE_KEY).agg(F.count(F.lit(1)).alias("size"))
        keyed.write.mode("overwrite").parquet(f"{self.path}/closed/batch_id={self._batch}")
        return self.pair(rows)

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """SS5: rows that came after their time, with the batch that brought them in ``batch_id``."""
        return spark.read.parquet(f"{self.path}/late")

    def late_counts(self, spark: SparkSession) -> DataFrame:
        """SS5: late rows of each batch and table."""
        return self.late_rows(spark).groupBy("batch_id", "capture_instance").agg(F.count(F.lit(1)).alias("late_rows"))

    def flush(self, spark: SparkSession, schema: T.StructType, last_batch: int, ceiling: str = _EVER) -> None:
        """After a stream has stopped for good: close what is open up to a ceiling, and pair changes that came late as a whole.

        Uses the two batch numbers after ``last_batch``. Late rows of a change that was closed without them stay
        in ``late`` alone.
        """
        self._batch = last_batch + 1
        timed = T.StructType([f if f.name != "commit_time" else T.StructField("commit_time", T.TimestampType()) for f in schema.fields])
        with staging(spark):
            late = stage(self._wholly_late(spark, last_batch, timed), "wholly-late")
            self._handle(spark.createDataFrame([], timed), last_batch + 1, up_to(ceiling))
            self._batch = last_batch + 2
            self.transform(late).write.mode("overwrite").parquet(f"{self.path}/events/batch_id={last_batch + 2}")

    def _wholly_late(self, spark: SparkSession, last_batch: int, schema: T.StructType) -> DataFrame:
        late = self.late_rows(spark).where(F.col("batch_id") <= last_batch)
        keyed = stage(changes.with_change_key(late.select(*schema.names)), "late")
        low, high = keyed.agg(F.min("start_lsn"), F.max("start_lsn")).first()
        if low is None:
            return keyed.select(*schema.names)
        key = list(CHANGE_KEY)
        closed = spark.read.parquet(f"{self.path}/closed").where((F.col("batch_id") <= last_batch) & F.col("start_lsn").between(low, high))
        # Only keys of late rows are kept of the closed ones: a map if the late keys are few.
        known = closed.select(*key).join(small_side(keyed.select(*key).distinct(), "late-keys"), key, "left_semi").distinct()
        return keyed.join(small_side(known, "known-late"), key, "left_anti").select(*schema.names)
