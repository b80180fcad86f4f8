"""Hot groups and distributed numbering."""

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.operators.skew import hot_groups, number_rows


def test_hot_groups_are_exact(spark):
    rng = random.Random(1)
    rows = [("big", 1)] * 500 + [("other", 2)] * 120 + [(f"k{rng.randrange(300)}", 3) for _ in range(900)]
    frame = spark.createDataFrame(rows, "k string, v int")
    found = hot_groups(frame, ["k"], 100, F.sum("v").alias("total"))
    assert sorted(map(tuple, found.collect())) == [("big", 500, 500), ("other", 120, 240)]
    assert hot_groups(frame, ["k"], 1000) is None
    assert hot_groups(frame.where("k = 'absent'"), ["k"], 1) is None


def test_numbering_equals_row_number(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(10**9), i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "g string, o bigint, i bigint").repartition(5)
    window = W.partitionBy("g").orderBy("o", "i")
    plain = {r["i"]: r["n"] for r in frame.withColumn("n", F.row_number().over(window)).where("g IS NOT NULL").collect()}
    found = number_rows(frame.where("g IS NOT NULL"), ["g"], ["o", "i"], "n", unique=True)
    assert {r["i"]: r["n"] for r in found.collect()} == plain


def test_numbering_without_group(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("o"))
    found = number_rows(frame, [], ["o"], "n", unique=True)
    values = sorted((r["o"], r["n"]) for r in found.collect())
    assert [n for _, n in values] == list(range(1, 5001))


def test_numbering_spreads_equal_rows(spark):
    rows = [("a", 1)] * 2000 + [("a", 2)] * 300 + [("b", 1)] * 5
    frame = spark.createDataFrame(rows, "g string, o int")
    found = number_rows(frame, ["g"], ["o"], "n").collect()
    assert sorted(r["n"] for r in found if r["g"] == "a") == list(range(1, 2301))
    assert sorted(r["n"] for r in found if (r["g"], r["o"]) == ("a", 1)) == list(range(1, 2001))
    assert sorted(r["n"] for r in found if r["g"] == "b") == [1, 2, 3, 4, 5]


def test_runs_of_copies(spark, monkeypatch):
    monkeypatch.setattr("tideline.operators.skew._COPY_RUN", 64)
    rows = [("a", 1)] * 1000 + [("a", 2)] * 64 + [("a", 3)] * 65
    found = number_rows(spark.createDataFrame(rows, "g string, o int"), ["g"], ["o"], "n").collect()
    assert sorted(r["n"] for r in found) == list(range(1, 1130))
    assert sorted(r["n"] for r in found if r["o"] == 3) == list(range(1065, 1130))


def test_large_transaction_is_split_in_the_time_join(spark):
    """A third of all rows in one transaction: the join divides that side at run time."""
    from tideline.plans.events import with_commit_time

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000)
        rows = spark.range(0, 300_000, 1, 8).select(F.lpad(F.hex(key), 20, "0").alias("start_lsn"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        log = spark.range(1000).select(F.lpad(F.hex("id"), 20, "0").alias("start_lsn"), F.lit("2024-01-01").cast("timestamp_ntz").alias("commit_time"))
        joined = with_commit_time(rows, log)
        assert joined.count() == 300_000
        joined = with_commit_time(rows, log)
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
