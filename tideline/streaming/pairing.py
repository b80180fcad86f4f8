"""SS3: pairing in a stream when the halves of a change arrive in different batches.

State per open change has a fixed size: counts and the first and last image. That decides every change of
one or two rows. A larger change is closed by its key alone and its rows are read again from the landed table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.model import AFTER_UPDATE, BEFORE_UPDATE, CHANGE_KEY, DELETE, INSERT
from tideline.operators import changes
from tideline.session import stage


def open_changes(rows: DataFrame, primary_key: Sequence[str], delay: str, no_time: str = "1970-01-01 00:00:00") -> DataFrame:
    """Collect changes until the watermark passes their commit time.

    ``rows`` need ``commit_time`` as a timestamp. A row without one would keep its change open for ever, so
    it gets ``no_time``: with the default it is late as soon as a watermark exists, and only ``PairingSink.flush``
    brings it out; give it the time of the run to keep it in the stream.
    """
    keyed = changes.with_change_key(rows)
    image = [c for c in changes.captured_columns(keyed)]
    order = ["operation", *primary_key, *[c for c in image if c not in primary_key]]
    timed = keyed.withColumn("commit_time", F.coalesce("commit_time", F.lit(no_time).cast("timestamp")))
    halves = F.col("operation").isin(BEFORE_UPDATE, AFTER_UPDATE)
    return (
        timed.withWatermark("commit_time", delay)
        .groupBy("commit_time", *CHANGE_KEY)
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min(F.struct(*order)).alias("first"),
            F.max(F.struct(*order)).alias("last"),
            F.max(halves.cast("int")).cast("boolean").alias("has_update_half"),
        )
    )


def closed_events(closed: DataFrame, landed: DataFrame, primary_key: Sequence[str], strict: bool = True) -> DataFrame:
    """Events of changes that the watermark has closed; ``landed`` is the table the stream reads."""
    groups = stage(closed, "closed-changes")
    small = changes.events(_unfold(groups.where("size <= 2"), primary_key), strict)
    large = groups.where("size > 2").select("commit_time", *CHANGE_KEY)
    low, high, found = large.agg(F.min("start_lsn"), F.max("start_lsn"), F.count(F.lit(1))).first()
    if not found:
        return small
    rows = changes.with_change_key(landed.where(F.col("start_lsn").between(low, high)))
    rows = rows.join(large.drop("commit_time"), list(CHANGE_KEY), "left_semi").drop("command_key")
    times = large.select("start_lsn", "commit_time").distinct()
    found_large = changes.events(changes.classify(rows.drop("commit_time"), primary_key), strict)
    return small.unionByName(found_large.join(times, "start_lsn").select(*small.columns))


def _unfold(groups: DataFrame, primary_key: Sequence[str]) -> DataFrame:
    """One or two rows per change again, with serial and kind as the batch form has them."""
    first, last = F.col("first"), F.col("last")
    moved = F.lit(False)
    for name in primary_key:
        moved = moved | ~first[name].eqNullSafe(last[name])
    pair = F.col("size") == 2
    kind = (
        F.when(
            pair & (first["operation"] == BEFORE_UPDATE) & (last["operation"] == AFTER_UPDATE),
            changes.UPDATE_PAIR,
        )
        .when(
            pair & (first["operation"] == DELETE) & (last["operation"] == INSERT),
            F.when(moved, changes.KEY_MOVE).otherwise(changes.DEFERRED_UPDATE),
        )
        .otherwise(changes.SINGLE)
    )
    images = F.when(pair, F.array(first, last)).otherwise(F.array(first))
    return groups.select(
        "commit_time",
        *CHANGE_KEY,
        "has_update_half",
        kind.alias("kind"),
        F.posexplode(images).alias("at", "image"),
    ).select(
        "commit_time",
        *CHANGE_KEY,
        "has_update_half",
        "kind",
        (F.col("at") + 1).cast("bigint").alias("serial"),
        "image.*",
    )


class PairingSink:
    """``foreachBatch`` target for ``open_changes``; each batch overwrites its own folder."""

    def __init__(self, path: str, landed: DataFrame, primary_key: Sequence[str], strict: bool = True) -> None:
        self.path, self.landed, self.primary_key, self.strict = path, landed, primary_key, strict

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = stage(batch, "closed-batch")
        batch.select(*CHANGE_KEY, "size").write.mode("overwrite").parquet(f"{self.path}/sizes/batch_id={batch_id}")
        events = closed_events(batch, self.landed, self.primary_key, self.strict)
        events.write.mode("overwrite").parquet(f"{self.path}/events/batch_id={batch_id}")

    def flush(self, last_batch: int) -> None:
        """After a stream has stopped for good: pair the landed changes that the stream never closed.

        These are the newest ones, those without a commit time and those that came late as a whole. A change that was
        closed before all of its rows had come keeps its events, and all of its landed rows are written below ``late``.
        Uses the batch number after ``last_batch``; a stream that goes on later must use another folder.
        """
        keyed = changes.with_change_key(self.landed)
        closed = keyed.sparkSession.read.parquet(f"{self.path}/sizes").where(F.col("batch_id") <= last_batch)
        closed = closed.groupBy(*CHANGE_KEY).agg(F.sum("size").alias("closed_rows"))
        found = keyed.groupBy(*CHANGE_KEY).agg(F.count(F.lit(1)).alias("landed_rows")).alias("f")
        same = [F.col(f"f.{c}").eqNullSafe(F.col(f"c.{c}")) for c in CHANGE_KEY]
        found = found.join(closed.alias("c"), same, "left").select("f.*", "closed_rows")
        found = stage(found.where("closed_rows IS NULL OR closed_rows < landed_rows"), "not-closed")

        def rows_of(groups: DataFrame) -> DataFrame:
            same = [F.col(f"k.{c}").eqNullSafe(F.col(f"g.{c}")) for c in CHANGE_KEY]
            return keyed.alias("k").join(groups.alias("g"), same, "left_semi").drop("command_key")

        rows_of(found.where("closed_rows IS NOT NULL")).write.mode("overwrite").parquet(f"{self.path}/late")
        rows = rows_of(found.where("closed_rows IS NULL"))
        times = rows.groupBy("start_lsn").agg(F.max("commit_time").alias("commit_time"))
        events = changes.events(changes.classify(rows.drop("commit_time"), self.primary_key), self.strict)
        events = events.join(times, "start_lsn", "left")
        events.write.mode("overwrite").parquet(f"{self.path}/events/batch_id={last_batch + 1}")
