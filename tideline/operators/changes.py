"""Change pairing: raw change rows become one or two events per logical change.

All rows of a change share (capture instance, position, command id, sequence value). One shuffle brings
them together; one window pass over the sorted change then decides its kind. Groups too large for one task
can never be a pair, so they skip the window altogether (see ``_classify_hot``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tideline.model import AFTER_UPDATE, BEFORE_UPDATE, CHANGE_KEY, DELETE, INSERT, SYSTEM_COLUMNS
from tideline.operators.skew import GROUP_ROWS_PER_TASK, hot_groups, number_rows

UPDATE_PAIR, DEFERRED_UPDATE, KEY_MOVE, SINGLE = "update_pair", "deferred_update", "key_move", "single"


def _op() -> Column:
    return F.col("operation")


def _is_update_half() -> Column:
    """Never null: a row without an operation code is no half of a pair, it is an unknown operation."""
    return F.coalesce(_op().isin(BEFORE_UPDATE, AFTER_UPDATE), F.lit(False))


def with_change_key(rows: DataFrame, use_command_id: bool = True) -> DataFrame:
    """PF5, PF6: name the null-safe command key, so that all windows share one exchange."""
    if use_command_id and "command_id" in rows.columns:
        return rows.withColumn("command_key", F.coalesce(F.col("command_id"), F.lit(-1)))
    return rows.withColumn("command_id", F.lit(None).cast("int")).withColumn("command_key", F.lit(-1))


def captured_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in (*SYSTEM_COLUMNS, "command_key", "commit_time")]


def change_groups(rows: DataFrame) -> DataFrame:
    """AG1, AG2: size and sorted operation list of every change, as counts per operation code.

    The list is kept run-length coded (``1x2,3x1``), so its size does not depend on the group.
    """
    keyed = with_change_key(rows)
    known = {code: F.count_if(_op() == code) for code in (DELETE, INSERT, BEFORE_UPDATE, AFTER_UPDATE)}
    counted = keyed.groupBy(*CHANGE_KEY).agg(
        F.count(F.lit(1)).alias("group_rows"),
        *[n.alias(f"ops_{code}") for code, n in known.items()],
    )
    runs = [
        F.when(F.col(f"ops_{code}") > 0, F.concat(F.lit(f"{code}x"), F.col(f"ops_{code}").cast("string")))
        for code in known
    ]
    other = F.col("group_rows") - sum((F.col(f"ops_{code}") for code in known), F.lit(0))
    runs.append(F.when(other > 0, F.concat(F.lit("?x"), other.cast("string"))))
    return counted.select(*CHANGE_KEY, "group_rows", F.concat_ws(",", *runs).alias("operations"))


def classify(
    rows: DataFrame,
    primary_key: Sequence[str],
    use_command_id: bool = True,
    hot_rows: int = GROUP_ROWS_PER_TASK,
    previous_image: bool = False,
) -> DataFrame:
    """CP1, CP5, WN3, WN6: every change row with its serial, the kind of its change and what is wrong with it.

    Adds ``serial`` (1-based, by operation, ties broken by key and then the other columns' hash), ``kind``,
    ``has_update_half`` and, on request, ``previous`` (the image one row earlier in the change).
    """
    keyed = with_change_key(rows, use_command_id)
    return classify_known(keyed, primary_key, find_hot(keyed, hot_rows), previous_image)


def find_hot(keyed: DataFrame, hot_rows: int = GROUP_ROWS_PER_TASK) -> DataFrame | None:
    """Changes too large for one task, among rows with their change key; None if there are none.

    More than two rows are never a pair, which is what the split in ``classify_known`` builds on.
    """
    halves = F.max(_is_update_half().cast("int")).cast("boolean").alias("has_update_half")
    return hot_groups(keyed, CHANGE_KEY, max(2, hot_rows), halves)


def classify_known(
    keyed: DataFrame, primary_key: Sequence[str], hot: DataFrame | None, previous_image: bool = False
) -> DataFrame:
    """``classify`` for rows with their change key, once the large changes are known."""
    if hot is None:
        return _classify_window(keyed, primary_key, previous_image)
    key = list(CHANGE_KEY)
    usual = keyed.join(hot.select(*key), key, "left_anti").select(*keyed.columns)
    large = keyed.join(hot.select(*key, "has_update_half"), key)
    return _classify_window(usual, primary_key, previous_image).unionByName(
        _classify_hot(large, keyed.columns, primary_key, previous_image)
    )


def _with_tie(rows: DataFrame, primary_key: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Order inside a change: operation, key, then a hash of the other captured columns.

    The hash makes reruns agree and keeps wide columns out of sorts and out of the samples of a range split.
    """
    rest = [c for c in columns if c not in primary_key]
    order = ["operation", *primary_key]
    if not rest:
        return rows, order
    return rows.withColumn("__tie", F.xxhash64(*rest)), [*order, "__tie"]


def _classify_window(keyed: DataFrame, primary_key: Sequence[str], previous_image: bool) -> DataFrame:
    # One specification for the running and the whole-group values: one exchange, one sort, one pass.
    image = captured_columns(keyed)
    tied, order = _with_tie(keyed, primary_key, image)
    change = W.partitionBy(*CHANGE_KEY).orderBy(*order)
    whole = change.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # Named first, so that every whole-group value is computed once; plain aggregates share one frame.
    key = F.struct(*primary_key) if primary_key else F.lit(0)
    values = {
        "serial": F.row_number().over(change).cast("bigint"),
        "has_update_half": F.max(_is_update_half()).over(whole),
        "__size": F.count(F.lit(1)).over(whole),
        "__first": F.min("operation").over(whole),
        "__last": F.max("operation").over(whole),
        "__low_key": F.min(key).over(whole),
        "__high_key": F.max(key).over(whole),
    }
    if previous_image:
        values["previous"] = F.lag(F.struct(*image)).over(change)
    moved = ~F.col("__low_key").eqNullSafe(F.col("__high_key"))
    pair, first, last = F.col("__size") == 2, F.col("__first"), F.col("__last")
    kind = (
        F.when(pair & (first == BEFORE_UPDATE) & (last == AFTER_UPDATE), UPDATE_PAIR)
        .when(pair & (first == DELETE) & (last == INSERT), F.when(moved, KEY_MOVE).otherwise(DEFERRED_UPDATE))
        .otherwise(SINGLE)
    )
    kept = [*keyed.columns, "serial", kind.alias("kind"), "has_update_half"]
    return tied.withColumns(values).select(*kept, *(["previous"] if previous_image else []))


def _classify_hot(large: DataFrame, columns: list[str], primary_key: Sequence[str], previous_image: bool) -> DataFrame:
    # More than two rows: always single changes, so only the serial needs the order.
    image = [c for c in captured_columns(large) if c != "has_update_half"]
    tied, order = _with_tie(large, primary_key, image)
    numbered = number_rows(tied, CHANGE_KEY, order, "serial")
    out = numbered.select(*columns, "serial", F.lit(SINGLE).alias("kind"), "has_update_half")
    if previous_image:
        nothing = F.lit(None).cast(large.select(F.struct(*image)).schema[0].dataType)
        out = out.withColumn("previous", nothing)
    return out


def _paired() -> Column:
    return F.col("kind").isin(UPDATE_PAIR, DEFERRED_UPDATE)


def is_incomplete() -> Column:
    """A change with half an update pair."""
    return (F.col("kind") == SINGLE) & F.col("has_update_half")


def is_unknown_operation() -> Column:
    return (F.col("kind") == SINGLE) & F.coalesce(
        ~_op().isin(DELETE, INSERT, BEFORE_UPDATE, AFTER_UPDATE), F.lit(True)
    )


def events(classified: DataFrame, strict: bool = True) -> DataFrame:
    """CP2-CP8, CP10: keep the rows that are events and name their operation in ``__op``.

    An unknown operation code fails the job, and so does an incomplete update pair when ``strict``; both
    happen inside the plan, so no extra pass is needed and nothing is published. With ``strict`` off the
    orphan halves are dropped; ``incomplete_pairs`` lists them.
    """
    where = F.concat_ws(" ", "capture_instance", "start_lsn", "seqval")
    keep = (
        F.when(_paired(), F.col("serial") == 2)
        .when(F.col("kind") == KEY_MOVE, F.lit(True))
        .otherwise(_op().isin(DELETE, INSERT))
    )
    if strict:
        keep = F.when(
            is_incomplete(), F.raise_error(F.concat(F.lit("incomplete update pair: "), where)).cast("boolean")
        ).otherwise(keep)
        keep = F.when(is_unknown_operation() & ~F.col("has_update_half"), _unknown(where)).otherwise(keep)
    else:
        keep = F.when(is_unknown_operation(), _unknown(where)).otherwise(keep)
    op = F.when(_paired(), "u").when(_op() == DELETE, "d").otherwise("c")
    return classified.where(keep).withColumn("__op", op)


def event_counts(rows: DataFrame, key: Column, use_command_id: bool = True, strict: bool = True) -> DataFrame:
    """AG4: the number of ``events`` of every transaction, without pairing its rows.

    One hash aggregate per change counts its rows by operation and takes the lowest and highest 64-bit hash of ``key``;
    that tells how many events it is. No row is sorted, and no image is read. A moved key passes for a kept one only if
    both have the same hash. Refuses what ``events`` refuses.
    """
    keyed = with_change_key(rows, use_command_id).select(*CHANGE_KEY, "operation", F.xxhash64(key).alias("__key"))
    ops = {code: F.count_if(_op() == code).alias(f"__{code}") for code in (DELETE, INSERT, BEFORE_UPDATE, AFTER_UPDATE)}
    counted = keyed.groupBy(*CHANGE_KEY).agg(
        F.count(F.lit(1)).alias("__rows"), *ops.values(), F.min("__key").alias("__low"), F.max("__key").alias("__high")
    )
    n = lambda code: F.col(f"__{code}")
    size = F.col("__rows")
    update = (size == 2) & (n(BEFORE_UPDATE) == 1) & (n(AFTER_UPDATE) == 1)
    both = (size == 2) & (n(DELETE) == 1) & (n(INSERT) == 1)
    halves = n(BEFORE_UPDATE) + n(AFTER_UPDATE)
    unknown = size > n(DELETE) + n(INSERT) + halves
    where = F.concat_ws(" ", "capture_instance", "start_lsn", "seqval")
    events = F.when(update, F.lit(1)).when(both & (F.col("__low") == F.col("__high")), F.lit(1))
    if strict:
        half = F.raise_error(F.concat(F.lit("incomplete update pair: "), where)).cast("bigint")
        events = events.when(halves > 0, half)
    code = F.raise_error(F.concat(F.lit("unsupported operation code in: "), where)).cast("bigint")
    events = events.when(unknown, code).otherwise(n(DELETE) + n(INSERT))
    counts = counted.select("capture_instance", "start_lsn", events.cast("bigint").alias("events"))
    return counts.groupBy("capture_instance", "start_lsn").agg(F.sum("events").alias("events"))


def _unknown(where: Column) -> Column:
    text = F.concat(F.lit("unsupported operation code "), F.coalesce(_op().cast("string"), F.lit("null")), F.lit(": "))
    return F.raise_error(F.concat(text, where)).cast("boolean")


def incomplete_pairs(classified: DataFrame) -> DataFrame:
    """CP7: the update halves that strict mode refuses and lenient mode drops."""
    return classified.where(is_incomplete() & _is_update_half())


def bad_operations(classified: DataFrame) -> DataFrame:
    """CP8: rows whose operation code is none of the four known ones."""
    return classified.where(is_unknown_operation())


def before_after(
    rows: DataFrame,
    primary_key: Sequence[str],
    use_command_id: bool = True,
    hot_rows: int = GROUP_ROWS_PER_TASK,
) -> DataFrame:
    """JN7: both images of every update, without a join."""
    found = classify(rows, primary_key, use_command_id, hot_rows, previous_image=True)
    image = captured_columns(with_change_key(rows, use_command_id))
    return found.where(_paired() & (F.col("serial") == 2)).select(
        *CHANGE_KEY,
        "kind",
        *[F.col(f"previous.{c}").alias(f"before_{c}") for c in image],
        *[F.col(c).alias(f"after_{c}") for c in image],
    )
