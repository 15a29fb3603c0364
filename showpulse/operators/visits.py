"""Idle-separated visits: a visit starts at a key's first event and after every gap longer than `gap`.

The table is first reduced to slots as long as the gap. Two events in one slot are never more than the gap apart,
so only the first event of a slot can start a visit, and a slot needs no more than its first event, last time
and size. After this reduction a key has at most one row per slot, however many events it had.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showpulse.functions.durations import exceeds
from showpulse.operators.blocks import ROWS_PER_BLOCK, split_groups
from showpulse.operators.columns import attach, names, pick_row


def starts_visit(first: Column, previous: Column, gap: str) -> Column:
    return previous.isNull() | exceeds(first, previous, gap)


def visit_slots(df: DataFrame, keys: str | list[str], ts: str, order: str | list[str], gap: str) -> DataFrame:
    """One row per key and slot: keys, `_slot`, `_row` (its first event), `_last`, `_events`, `_starts`."""
    keys, order = names(keys), names(order)
    slots = pick_row(
        df,
        [*keys, F.window(ts, gap).alias("_slot")],
        [ts, *order],
        _last=F.max(ts),
        _events=F.count(F.lit(1)),
    )
    previous = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slot"))
    return slots.withColumn("_starts", starts_visit(F.col(f"_row.{ts}"), previous, gap))


def ordered_visits(
    df: DataFrame,
    keys: str | list[str],
    ts: str,
    order: str | list[str],
    gap: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Every event, with `_starts` (it starts a visit) and `_nth` (its number within its visit, from 1).

    An event without a time belongs to no visit: both are null, and other events are numbered as if it were not there.
    """
    keys, order = names(keys), names(order)
    blocks = split_groups(df, keys, [ts, *order], rows_per_block)

    # What the first event of a block inherits: whether it starts a visit, and how long the visit already is.
    slots = blocks.split.groupBy(*keys, "_block", F.window(ts, gap).alias("_slot")).agg(
        F.count(F.lit(1)).alias("_events"), F.min(ts).alias("_first"), F.max(ts).alias("_last")
    )
    in_key = Window.partitionBy(*keys).orderBy("_block", "_slot")
    in_visit = Window.partitionBy(*keys, "_visit").orderBy("_block", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    inherited = (
        slots.withColumn("_starts", starts_visit(F.col("_first"), F.lag("_last").over(in_key), gap))
        .withColumn("_visit", F.sum(F.col("_starts").cast("int")).over(in_key))
        .withColumn("_before", F.coalesce(F.sum("_events").over(in_visit), F.lit(0)))
        .withColumn("_nth_slot", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy("_slot")))
        .where("_nth_slot = 1 AND _block > 0")
        .select(*keys, "_block", F.col("_starts").alias("_block_starts"), "_before")
    )

    # Events without a time come first in their key; here they are a group of their own.
    timed = F.col(ts).isNotNull()
    in_block = Window.partitionBy(*keys, "_block", timed).orderBy(ts, *order)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = F.when(F.col("_at") == 1, F.coalesce("_block_starts", F.lit(True))).otherwise(
        exceeds(F.col(ts), F.col("_previous"), gap)
    )
    first_of_visit = F.max(F.when(F.col("_starts"), F.col("_at"))).over(so_far)
    return (
        attach(blocks.rows, inherited, [*keys, "_block"])
        .withColumn("_at", F.row_number().over(in_block))
        .withColumn("_previous", F.lag(ts).over(in_block))
        .withColumn("_starts", starts)
        .withColumn("_nth", F.col("_at") + 1 - F.coalesce(first_of_visit, 1 - F.col("_before")))
        .select(*df.columns, F.when(timed, F.col("_starts")).alias("_starts"), F.when(timed, F.col("_nth").cast("long")).alias("_nth"))
    )
