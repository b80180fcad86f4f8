"""Documents to shards by jump consistent hashing. DataFrame functions only.

A stable key starts a fixed sequence of random numbers, and the key jumps along it from shard to shard, ever further,
until the next jump would pass the last shard. There is no table of shards; with one more shard only the keys whose
next jump lands on it move, and they move only there. The random numbers are 64-bit hashes of key and jump number.

The shard of a row is decided by its key and the number of shards alone, so copies of a text under different ids are
placed apart, and rows that repeat an id come together. A null key is a key of its own. Null text has no bytes, and
the checksum of the empty text. Each row gets a row and a slot of its own; an empty table gives an empty result.
Columns besides key and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.session import small_side, stage

SHARDS = 24
OVERHEAD = 8
#: Bytes that a row takes besides its text.

_JUMPS = 200
#: A key jumps about ln(shards) times; 200 jumps don't happen even among 2**31 shards, and would be an error.


def jump(key: Column, shards: int) -> Column:
    """The shard of a key, 0 to ``shards - 1``."""
    if not 0 < shards < 1 << 31:
        raise ValueError("the number of shards must be positive and fit in 31 bits")

    def step(state: Column, turn: Column) -> Column:
        chance = (F.shiftrightunsigned(F.xxhash64(key, turn), 33) + 1) / F.lit(float(1 << 31))
        further = F.floor((state["next"] + 1) / chance)
        ended = state["next"] >= shards
        return F.struct(
            F.when(ended, state["shard"]).otherwise(state["next"]).alias("shard"),
            F.when(ended, state["next"]).otherwise(further).alias("next"),
        )

    start = F.struct(F.lit(-1).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("next"))
    turns = F.sequence(F.lit(1), F.lit(min(shards, _JUMPS)))
    done = lambda s: F.when(s["next"] >= shards, s["shard"]).otherwise(F.raise_error(F.lit("too many jumps")).cast("bigint"))
    return F.aggregate(turns, start, step, done).cast("int")


def numbered(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Number the rows of each group from 0 without a gap.

    Each input partition numbers its own rows of a group after those of the partitions before it, so no task holds
    more of a group than one partition had, however large the group is.
    """
    placed = stage(rows.withColumn("__at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part", group).agg(F.count(F.lit(1)).alias("__size"))
    before = W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select("__part", group, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    own = F.row_number().over(W.partitionBy("__part", group).orderBy("__at"))
    joined = placed.withColumn("__own", own).join(small_side(shifts, "shifts"), ["__part", group])
    return joined.withColumn(name, F.col("__own") + F.col("__shift") - 1).drop("__part", "__at", "__own", "__shift")


def sharded(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Size, checksum, shard, slot in the shard, and the shard if there were one more, of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump(F.col(key), shards).alias("shard"),
        jump(F.col(key), shards + 1).alias("grown_shard"),
    )
    return numbered(rows, "shard", "slot").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def sharded_documents(spark, sf_dir: str) -> DataFrame:
    """op3: the shard of every document."""
    return sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
