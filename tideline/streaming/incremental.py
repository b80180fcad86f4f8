"""SS1, SS2, SS6: read what is new, handle whole transactions only, write each batch once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from tideline.session import numbers, remove, small_side, stage, staging

# Decides which of the open transactions (``start_lsn`` and how many ``rows`` there are so far) are complete.
Ready = Callable[[DataFrame], Column]
Transform = Callable[[DataFrame], DataFrame]


def read_change_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """SS1: landed change rows as a stream; a source checkpoint plays the part of the bookmark."""
    reader: DataStreamReader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def up_to(ceiling: str) -> Ready:
    """Everything up to a known ceiling is complete."""
    return lambda rows: F.col("start_lsn") <= ceiling


def before_newest(rows: DataFrame) -> Column:
    """For rows that arrive in log order: a transaction is complete once a later one was seen."""
    newest = rows.agg(F.max("start_lsn")).first()[0]
    return F.col("start_lsn") < newest if newest else F.lit(False)


class TransactionSink:
    """``foreachBatch`` target that holds incomplete transactions back for a later batch.

    Held rows lie in segments: batch ``n`` appends the rows of transactions that stay open to ``segments/batch_id=n``, once.
    ``open/batch_id=n`` is the index after the batch: one row for each open transaction with its position, its rows so far
    and the segments that have some of them. A transaction that is closed is read from its segments and leaves the index;
    no row is moved. Segments that the index no longer names are removed a batch later, and when more than
    ``most_segments`` are in use their open rows are gathered in the newest one.

    Batch ``n`` reads only what batch ``n - 1`` left and overwrites folders of its own number, so a batch that is repeated
    after a failure replaces its earlier attempt. ``ready`` sees the index, not the rows.
    """

    def __init__(self, path: str, transform: Transform, ready: Ready, most_segments: int = 64) -> None:
        self.path, self.transform, self.ready, self.most_segments = path, transform, ready, most_segments

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._handle(batch, batch_id, self.ready)

    def _handle(self, batch: DataFrame, batch_id: int, ready: Ready) -> None:
        spark = batch.sparkSession
        with staging(spark):
            earlier = self.open_transactions(spark, batch_id - 1)
            index = stage(self._with_arrived(earlier, batch, batch_id), "open-transactions")
            complete = ready(index)
            held = self._held(spark, earlier.where(complete), batch.schema)
            rows = batch.where(complete)
            rows = rows if held is None else rows.unionByName(held)
            self.transform(rows).write.mode("overwrite").parquet(f"{self.path}/events/batch_id={batch_id}")
            self._keep(batch.where(~complete), index.where(~complete), earlier, complete, batch_id)
        self._remove_unused(spark, batch_id)

    def _with_arrived(self, earlier: DataFrame, batch: DataFrame, batch_id: int) -> DataFrame:
        """The index with the rows of this batch counted in."""
        arrived = batch.groupBy("start_lsn").agg(F.count(F.lit(1)).alias("rows"), *self._facts())
        arrived = arrived.withColumn("segments", F.array(F.lit(batch_id).cast("bigint")))
        merged = earlier.unionByName(arrived).groupBy("start_lsn")
        segments = F.array_sort(F.array_distinct(F.flatten(F.collect_list("segments"))))
        return merged.agg(F.sum("rows").alias("rows"), segments.alias("segments"), *self._facts())

    def _facts(self) -> list[Column]:
        """More columns of the index: aggregates over columns that rows and index share."""
        return []

    def _index_schema(self) -> str:
        return "start_lsn string, rows bigint, segments array<bigint>"

    def _keep(self, rows: DataFrame, index: DataFrame, earlier: DataFrame, complete: Column, batch_id: int) -> None:
        """Append the open rows of the batch, and write the index that names them."""
        spark = rows.sparkSession
        # Segments are numbers of batches, a few of them.
        used = [r[0] for r in index.select(F.explode("segments")).distinct().collect()]
        if len(used) > self.most_segments:
            held = self._held(spark, earlier.where(~complete), rows.schema)
            rows = rows if held is None else rows.unionByName(held)
            index = index.withColumn("segments", F.array(F.lit(batch_id).cast("bigint")))
        rows.write.mode("overwrite").parquet(f"{self.path}/segments/batch_id={batch_id}")
        index.write.mode("overwrite").parquet(f"{self.path}/open/batch_id={batch_id}")

    def open_transactions(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The index that a batch has left."""
        if batch_id < 0:
            return spark.createDataFrame([], self._index_schema())
        return spark.read.schema(self._index_schema()).parquet(f"{self.path}/open/batch_id={batch_id}")

    def _held(self, spark: SparkSession, transactions: DataFrame, schema: T.StructType) -> DataFrame | None:
        """The held rows of some open transactions, from the segments that have them; None if there are none."""
        segments = [r[0] for r in transactions.select(F.explode("segments")).distinct().collect()]
        if not segments:
            return None
        low, high = transactions.agg(F.min("start_lsn"), F.max("start_lsn")).first()
        rows = spark.read.schema(schema).parquet(*[f"{self.path}/segments/batch_id={n}" for n in sorted(segments)])
        wanted = small_side(transactions.select("start_lsn"), "wanted-transactions")
        return rows.where(F.col("start_lsn").between(low, high)).join(wanted, "start_lsn", "left_semi").select(*schema.names)

    def _remove_unused(self, spark: SparkSession, batch_id: int) -> None:
        """Drop segments and indexes that neither the next batch nor a repetition of this one reads."""
        needed = set()
        for n in (batch_id - 1, batch_id):
            needed |= {r[0] for r in self.open_transactions(spark, n).select(F.explode("segments")).distinct().collect()}
        for name, keep in (("segments", needed | {batch_id}), ("open", {batch_id - 1, batch_id})):
            for n in numbers(spark, f"{self.path}/{name}"):
                if n < batch_id and n not in keep:
                    remove(spark, f"{self.path}/{name}/batch_id={n}")

    def flush(self, spark: SparkSession, schema: T.StructType, last_batch: int, ceiling: str) -> None:
        """After a stream has stopped for good: handle what is still held, up to a ceiling.

        Uses the batch number after ``last_batch``; a stream that goes on later must use another folder.
        """
        self._handle(spark.createDataFrame([], schema), last_batch + 1, up_to(ceiling))

    def events(self, spark: SparkSession) -> DataFrame:
        """All events written so far."""
        return spark.read.parquet(f"{self.path}/events")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """SS1: handle everything that has arrived, then stop."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

