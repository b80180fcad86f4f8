"""Change tables derived from the test tables (see FIXTURES.md, part B), each from one scan of its base."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.lsn import hex_digits
from tideline.model import CapturedTable, Origin
from tideline.sources.change_tables import ChangeSource

ORIGIN = Origin(topic_prefix="server1", database="sales", timezone="America/New_York")


def _lsn(file: Column | int, tx: Column, slot: Column | int) -> Column:
    parts = zip((file, tx, slot), (8, 8, 4), strict=True)
    return F.concat(*[hex_digits(p if isinstance(p, Column) else F.lit(p), size) for p, size in parts])


def _image(op: int, key: Column, value: Column) -> Column:
    return F.struct(F.lit(op).alias("operation"), key.alias("id"), value.alias("value"))


class Fixtures:
    """Derived inputs for one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def ct(self) -> DataFrame:
        n, v = F.col("event_id"), F.col("value")
        k = n % 10
        images = (
            F.when(k <= 3, F.array(_image(2, n, v)))
            .when(k <= 6, F.array(_image(3, n - 4, v - 1), _image(4, n - 4, v)))
            .when(k == 7, F.array(_image(1, n - 7, v)))
            .when(k == 8, F.array(_image(1, n - 7, v - 1), _image(2, n - 7, v)))
            .otherwise(F.array(_image(1, n - 7, v), _image(2, n - 7 + 1_000_000, v)))
        )
        tx, pos = F.expr("event_id div 5"), n % 5
        return self.table("events").select(
            F.lit("dbo_events").alias("capture_instance"),
            _lsn(39, tx, 1).alias("start_lsn"),
            _lsn(39, tx, pos + 2).alias("seqval"),
            (pos + 1).cast("int").alias("command_id"),
            F.col("event_type").alias("name"),
            F.inline(images),
        ).select("capture_instance", "start_lsn", "seqval", "command_id", "operation", "id", "name", "value")

    @cached_property
    def lsn_time(self) -> DataFrame:
        tx = F.expr("event_id div 5")
        return (
            self.table("events")
            .where(tx % 50 != 7)
            .groupBy(tx.alias("tx"))
            .agg(F.max("ts").alias("commit_time"))
            .select(_lsn(39, F.col("tx"), 1).alias("start_lsn"), "commit_time")
        )

    @cached_property
    def ct_orders(self) -> DataFrame:
        def image(file: int, op: int, status: str) -> Column:
            return F.struct(F.lit(file).alias("file"), F.lit(op).alias("operation"), F.lit(status).alias("status"))

        tx, pos = F.expr("o_orderkey div 8"), F.col("o_orderkey") % 8
        finished = F.array(image(40, 2, "O"), image(41, 3, "O"), image(41, 4, "F"))
        images = F.when(F.col("o_orderstatus") == "F", finished).otherwise(F.array(image(40, 2, "O")))
        return (
            self.table("orders")
            .select("o_orderkey", "o_totalprice", tx.alias("tx"), pos.alias("pos"), F.inline(images))
            .select(
                F.lit("dbo_orders").alias("capture_instance"),
                _lsn(F.col("file"), F.col("tx"), 1).alias("start_lsn"),
                _lsn(F.col("file"), F.col("tx"), F.col("pos") + 2).alias("seqval"),
                (F.col("pos") + 1).cast("int").alias("command_id"),
                "operation",
                F.col("o_orderkey").alias("id"),
                "status",
                F.col("o_totalprice").alias("totalprice"),
            )
        )

    @cached_property
    def ct_orphan(self) -> DataFrame:
        return self.ct.where(~((F.col("operation") == 4) & (F.col("id") % 97 == 0)))

    @cached_property
    def ct_badop(self) -> DataFrame:
        bad = (F.col("id") == 10) & (F.col("operation") == 2)
        return self.ct.withColumn("operation", F.when(bad, 5).otherwise(F.col("operation")))

    @cached_property
    def ct_shared_seq(self) -> DataFrame:
        return self.ct.withColumn("seqval", F.col("start_lsn"))

    @cached_property
    def both(self) -> DataFrame:
        """System columns of both captured tables."""
        shared = ["capture_instance", "start_lsn", "seqval", "command_id", "operation"]
        return self.ct.select(*shared).unionByName(self.ct_orders.select(*shared))

    @cached_property
    def bookmarks(self) -> DataFrame:
        saved = [("dbo_events", "00000027000001F40001"), ("dbo_old", "00000010000000010001")]
        return self.spark.createDataFrame(saved, "capture_instance string, lsn string")

    @cached_property
    def events_table(self) -> CapturedTable:
        return CapturedTable.of("dbo_events", self.ct, ("id",))

    @cached_property
    def orders_table(self) -> CapturedTable:
        return CapturedTable.of("dbo_orders", self.ct_orders, ("id",))

    @cached_property
    def customer_table(self) -> CapturedTable:
        return CapturedTable.of("dbo_customer", self.table("customer"), ("c_custkey",))

    @property
    def sources(self) -> list[ChangeSource]:
        return [ChangeSource(self.events_table, self.ct), ChangeSource(self.orders_table, self.ct_orders)]
