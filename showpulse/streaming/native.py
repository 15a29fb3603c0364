"""Stream operators that are plain streaming aggregations. The window operators of `operators.windows` also take streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showpulse.operators.columns import names
from showpulse.operators.counts import count_by
from showpulse.operators.totals import KEYS


def running_total_stream(df: DataFrame, keys: str | list[str] = KEYS) -> DataFrame:
    """All-time totals for update mode: each micro-batch gives the new total of every key it holds, and of no other.

    State is one number per key and is never given up.
    """
    return count_by(df, keys)


def session_first_stream(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    order: str | list[str] = "event_id",
    gap: str = "3600 seconds",
    lateness: str = "0 seconds",
) -> DataFrame:
    """The first event of each closed visit, for append mode; a visit closes when the watermark has passed its gap."""
    timed = df.withWatermark(ts, lateness)
    sessions = timed.groupBy(user, F.session_window(ts, gap).alias("_visit")).agg(
        F.min_by(F.struct(*df.columns), F.struct(ts, *names(order))).alias("_row"),
        F.max(ts).alias("visit_end"),
        F.count(F.lit(1)).alias("visit_events"),
    )
    return sessions.select("_row.*", "visit_end", "visit_events")
