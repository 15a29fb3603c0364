"""Running totals of events per key, with and without a reset after inactivity."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showpulse.operators.blocks import ROWS_PER_BLOCK, split_groups
from showpulse.operators.columns import attach, names, whole
from showpulse.operators.latest import latest
from showpulse.operators.visits import ordered_visits

KEYS = ("user_id", "show_id")


def running_total(
    df: DataFrame,
    keys: str | list[str] = KEYS,
    ts: str = "ts",
    order: str | list[str] = "event_id",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Every event with `total_count`, the number of events of its key so far: 1 where the key has a null part."""
    keys, at = names(keys), [ts, *names(order)]
    blocks = split_groups(df, keys, at, rows_per_block)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        blocks.split.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_events"))
        .withColumn("_before", F.sum("_events").over(earlier))
        .where("_block > 0")
        .select(*keys, "_block", "_before")
    )
    in_block = Window.partitionBy(*keys, "_block").orderBy(*at)
    total = F.row_number().over(in_block) + F.coalesce("_before", F.lit(0))
    own = F.when(whole(keys), total).otherwise(F.lit(1)).cast("long")
    return attach(blocks.rows, before, [*keys, "_block"]).select(*df.columns, own.alias("total_count"))


def running_total_idle(
    df: DataFrame,
    keys: str | list[str] = KEYS,
    ts: str = "ts",
    order: str | list[str] = "event_id",
    gap: str = "3600 seconds",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Every event with `total_count`, the number of events of its key since the key was last idle longer than `gap`.

    Events without a time are not counted and have no total; of other events, those whose key has a null part have 1.
    """
    visits = ordered_visits(df, keys, ts, order, gap, rows_per_block)
    own = F.when(whole(names(keys)) | F.col("_nth").isNull(), F.col("_nth")).otherwise(F.lit(1).cast("long"))
    return visits.select(*df.columns, own.alias("total_count"))


def running_total_updates(
    df: DataFrame, keys: str | list[str] = KEYS, ts: str = "ts", batch: str = "5 seconds"
) -> DataFrame:
    """One row per key and batch interval in which the key occurs: its total at the end of the interval."""
    keys = names(keys)
    counts = df.groupBy(*keys, F.window(ts, batch).alias("_batch")).agg(F.count(F.lit(1)).alias("batch_count"))
    so_far = Window.partitionBy(*keys).orderBy("_batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(
        *keys,
        F.col("_batch.start").alias("batch_start"),
        "batch_count",
        F.sum("batch_count").over(so_far).alias("total_count"),
    )


def newest_totals(
    df: DataFrame,
    keys: str | list[str] = KEYS,
    by: str | list[str] = KEYS,
    ts: str = "ts",
    order: str | list[str] = "event_id",
) -> DataFrame:
    """The last row of `running_total` for each value of `by` (some or all of the keys), without numbering every event.

    A total of all events of a key is the running total at the key's last event.
    """
    keys, at = names(keys), [ts, *names(order)]
    ends = df.groupBy(*keys).agg(F.max(F.struct(*at)).alias("_at"), F.count(F.lit(1)).alias("total_count"))
    return latest(ends, by, "_at").select(*keys, "_at.*", "total_count")
