"""Finding groups too large for one task, and numbering rows without giving a group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.session import small_side, stage

# A group of up to this many rows may be sorted (and spilled) by one task.
GROUP_ROWS_PER_TASK = 2_000_000

# Size of the histogram that bounds every group from above.
_BUCKETS = 16_384

# Copies of one row are numbered in runs of this length.
_COPY_RUN = 100_000


def hot_groups(rows: DataFrame, keys: Sequence[str], limit: int = GROUP_ROWS_PER_TASK, *aggregates: Column):
    """Groups with more rows than one task should hold, with their row count, or None.

    A histogram over hashed keys is summed up before the shuffle, so the common case costs one scan of
    the key columns and moves no rows. A bucket counts at least as many rows as any group in it, so a
    group above the limit cannot hide; only rows of suspicious buckets are counted exactly. The limit is the
    same at every size of the input. The result is broadcast only if its counted rows are few.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))
    histogram = rows.groupBy(bucket.alias("bucket")).count()
    # Never more than _BUCKETS numbers.
    counts = histogram.where(F.col("count") > limit).collect()
    suspects = [c["bucket"] for c in counts]
    if not suspects:
        return None
    if len(suspects) < _BUCKETS // 2:
        rows = rows.where(bucket.isin(suspects))
    groups = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("group_rows"), *aggregates)
        .where(F.col("group_rows") > limit)
    )
    groups = small_side(groups, "hot-groups")
    return groups if groups.head(1) else None


def number_rows(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str, unique: bool = False
) -> DataFrame:
    """``row_number() over (partition by group order by order)`` for groups of any size.

    Rows are range-partitioned by group and order, so a large group spreads over many tasks. Each task
    sorts its range and numbers it by position; the offset of a range within its group comes from a table
    of range sizes, which has at most one row per partition plus one per group. ``unique=False`` keeps
    the split possible when many rows agree on all ordering columns. Nulls sort first.
    """
    group, order = list(group), list(order)
    if not unique:
        rows, order = number_copies(rows), [*order, "__copy"]
    ranged = rows.repartitionByRange(*group, *order) if (group or order) else rows
    placed = stage(
        ranged.sortWithinPartitions(*group, *order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id()),
        "numbered",
    )
    ranges = placed.groupBy(*group, "__part").agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__size")
    )
    earlier = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.select(
        *group, "__part", (F.coalesce(F.sum("__size").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    numbered = placed.join(small_side(offsets, "offsets"), [*group, "__part"])
    return numbered.withColumn(name, F.col("__at") + F.col("__shift") + 1).drop(
        "__part", "__at", "__shift", "__copy"
    )


def number_copies(rows: DataFrame) -> DataFrame:
    """Give equal rows a running number. Copies are counted before the shuffle and unfolded after it.

    A row with very many copies is first cut into runs that are spread over the tasks.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    few = counted.where(F.col("__copies") <= _COPY_RUN).select(*columns, _unfold(F.lit(0), F.col("__copies")))
    run = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(__copies - 1) div {_COPY_RUN}")))
    runs = (
        counted.where(F.col("__copies") > _COPY_RUN)
        .select(*columns, "__copies", run.alias("__run"))
        .repartition(*columns, "__run")
    )
    first = F.col("__run") * _COPY_RUN
    many = runs.select(*columns, _unfold(first, F.least(first + _COPY_RUN, F.col("__copies"))))
    return few.unionByName(many)


def _unfold(first: Column, end: Column) -> Column:
    return F.explode(F.sequence(first.cast("bigint"), end - 1)).alias("__copy")
