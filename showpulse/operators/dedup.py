"""Count a user once: per batch, per idle gap, per visit."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showpulse.operators.blocks import ROWS_PER_BLOCK
from showpulse.operators.columns import names, pick_row
from showpulse.operators.visits import ordered_visits, visit_slots


def first_per_batch(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    order: str | list[str] = "event_id",
    batch: str = "5 seconds",
) -> DataFrame:
    """The earliest event of each user in each batch interval. Works on streams too."""
    return pick_row(df, [user, F.window(ts, batch).alias("_batch")], [ts, *names(order)]).select("_row.*")


def idle_gate(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    order: str | list[str] = "event_id",
    gap: str = "3600 seconds",
    flag: bool = False,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Events of users not seen for longer than `gap`; every sighting, kept or not, restarts the gap.

    With `flag`, all events are returned with the column `seen`, which is false on the events the gate lets through and
    null on events without a time, which the gate never lets through.
    """
    if flag:
        visits = ordered_visits(df, user, ts, order, gap, rows_per_block)
        return visits.select(*df.columns, (~F.col("_starts")).alias("seen"))
    return visit_slots(df, user, ts, order, gap).where("_starts").select("_row.*")


def session_first(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    order: str | list[str] = "event_id",
    gap: str = "3600 seconds",
) -> DataFrame:
    """One row per visit: its first event, with `visit_end` (last event) and `visit_events`."""
    in_user = Window.partitionBy(user).orderBy("_slot")
    visits = visit_slots(df, user, ts, order, gap).withColumn("_visit", F.sum(F.col("_starts").cast("int")).over(in_user))
    return (
        visits.groupBy(user, "_visit")
        .agg(
            F.min_by("_row", "_slot").alias("_row"),
            F.max("_last").alias("visit_end"),
            F.sum("_events").alias("visit_events"),
        )
        .select("_row.*", "visit_end", "visit_events")
    )
