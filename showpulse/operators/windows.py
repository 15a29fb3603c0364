"""Counts in sliding windows.

Events are first counted in panes as wide as the slide, and panes rather than events are copied to the windows that they lie
in. On tables this takes one shuffle, by key and calendar block (the hour, or the day where windows are longer): events whose
windows begin in two blocks go to both, each block gives the windows that begin in it, and a hot key is spread over blocks.
Streams keep panes (`pane_counts`, `pane_watchers`), and windows are put together from them when they are read
(`sliding_from_panes`, `watchers_from_panes`). `sliding_counts` and `watchers_per_window` take streams too, but copy
events to all windows there, as they do where the slide does not divide the length.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showpulse.functions.durations import micros
from showpulse.operators.columns import names
from showpulse.operators.totals import KEYS

LENGTH = "150 seconds"
SLIDE = "30 seconds"


def sliding_counts(
    df: DataFrame,
    keys: str | list[str] = KEYS,
    ts: str = "ts",
    length: str = LENGTH,
    slide: str = SLIDE,
    start: str | None = None,
) -> DataFrame:
    """Events per key in each window that holds any. `start` shifts the windows, which else align to the epoch."""
    keys = names(keys)
    if _has_panes(df, length, slide):
        placed = _in_blocks(df.select(*keys, _pane(ts, slide, start)), keys, length, slide)
        panes = placed.groupBy(*keys, "_block", "_pane").agg(F.count(F.lit(1)).alias("_events"))
        return (
            _copied(panes, length, slide)
            .groupBy(*keys, "_block", "window_start")
            .agg(F.sum("_events").alias("total_count"))
            .select(*keys, "window_start", _end(length), "total_count")
        )
    window = F.window(ts, length, slide, start).alias("_window")
    counts = df.groupBy(window, *keys).agg(F.count(F.lit(1)).alias("total_count"))
    return counts.select(
        *keys,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        "total_count",
    )


def pane_counts(
    df: DataFrame, keys: str | list[str] = KEYS, ts: str = "ts", slide: str = SLIDE, start: str | None = None
) -> DataFrame:
    """Events per key in each pane that holds any: keys, `window_start`, `total_count`. On a stream in update mode, each
    micro-batch gives the new counts of the panes that it adds to; an event is shuffled once, if at all.
    """
    panes = df.groupBy(F.window(ts, slide, slide, start).alias("_pane"), *names(keys)).agg(F.count(F.lit(1)).alias("total_count"))
    return panes.select(*names(keys), F.col("_pane.start").alias("window_start"), "total_count")


def sliding_from_panes(
    panes: DataFrame, keys: str | list[str] = KEYS, length: str = LENGTH, slide: str = SLIDE
) -> DataFrame:
    """The rows of `sliding_counts` from those of `pane_counts`."""
    keys = names(keys)
    _whole_panes(length, slide)
    copied = panes.select(*keys, "total_count", _starts(length, slide, "window_start"))
    counts = copied.groupBy(*keys, "window_start").agg(F.sum("total_count").alias("total_count"))
    return counts.select(*keys, "window_start", _end(length), "total_count")


def pane_ends(panes: DataFrame, length: str = LENGTH) -> DataFrame:
    """Panes with the end of the window that begins with them."""
    return panes.select("*", _end(length))


def pane_watchers(
    df: DataFrame,
    show: str = "show_id",
    user: str = "user_id",
    ts: str = "ts",
    slide: str = SLIDE,
    lateness: str | None = None,
) -> DataFrame:
    """Each user once for every show and pane: `show`, `user`, `pane_start`. Events without a user are left out.

    On a stream, which needs `lateness`, this is a stream in append mode of first sightings. State is one row per sighting,
    given up when no event can fall into its pane any more; events later than `lateness` may be dropped.
    """
    panes = df.where(F.col(user).isNotNull()).select(show, user, F.window(ts, slide, slide)["start"].alias("pane_start"))
    if df.isStreaming:
        if lateness is None:
            raise ValueError("on a stream, say by how much events may be late")
        # The watermark follows the starts of panes, which lie up to one slide before their events.
        panes = panes.withWatermark("pane_start", _seconds(micros(lateness) + micros(slide)))
    return panes.dropDuplicates([show, user, "pane_start"])


def watchers_from_panes(
    sightings: DataFrame, show: str = "show_id", user: str = "user_id", length: str = LENGTH, slide: str = SLIDE
) -> DataFrame:
    """The rows of `watchers_per_window` from those of `pane_watchers`."""
    _whole_panes(length, slide)
    return (
        sightings.select(show, user, _starts(length, slide, "pane_start"))
        .groupBy(show, "window_start")
        .agg(F.count_distinct(user).alias("watchers"))
        .select(show, "window_start", _end(length), "watchers")
    )


def _whole_panes(length: str, slide: str) -> None:
    if micros(length) % micros(slide):
        raise ValueError(f"windows of {length} do not consist of panes of {slide}")


def _seconds(duration: int) -> str:
    return f"{duration / 1e6:.6f} seconds"


def _has_panes(df: DataFrame, length: str, slide: str) -> bool:
    return not df.isStreaming and micros(length) % micros(slide) == 0 and micros(length) <= micros("1 day")


def _pane(ts: str, slide: str, start: str | None = None) -> Column:
    return F.window(ts, slide, slide, start)["start"].alias("_pane")


def _block(pane: Column, length: str) -> Column:
    """The calendar block of a window's start. A window is no longer than a block, so a pane's windows begin in two at most."""
    return F.date_trunc("hour" if micros(length) <= micros("1 hour") else "day", pane)


def _in_blocks(panes: DataFrame, keys: list[str], length: str, slide: str) -> DataFrame:
    """Rows with a `_pane` in the blocks that its windows begin in, shuffled by key and block.

    The number of partitions is set, as what is shuffled is a fraction of what is made of it there.
    """
    partitions = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    earliest = F.col("_pane") - _interval(micros(length) - micros(slide))
    blocks = F.array_distinct(F.array(_block(earliest, length), _block(F.col("_pane"), length)))
    return panes.withColumn("_block", F.explode(blocks)).repartition(partitions, *keys, "_block")


def _copied(panes: DataFrame, length: str, slide: str) -> DataFrame:
    """Panes copied to those of their windows that begin in the row's block."""
    copies = panes.withColumn("window_start", _starts(length, slide, "_pane"))
    return copies.where(_block(F.col("window_start"), length) == F.col("_block"))


def _interval(duration: int) -> Column:
    return F.expr(f"INTERVAL {duration / 1e6:.6f} SECOND")


def _starts(length: str, slide: str, pane: str) -> Column:
    """The starts of the windows that a pane lies in, one row each."""
    shifts = range(0, micros(length), micros(slide))
    return F.explode(F.array(*(F.col(pane) - _interval(shift) for shift in shifts))).alias("window_start")


def _end(length: str) -> Column:
    return (F.col("window_start") + _interval(micros(length))).alias("window_end")


def newest_windows(
    df: DataFrame,
    keys: str | list[str] = KEYS,
    ts: str = "ts",
    length: str = LENGTH,
    slide: str = SLIDE,
    start: str | None = None,
) -> DataFrame:
    """The row of `sliding_counts` with the newest window of each key, without copying any event or pane.

    A key's newest window begins with the pane of its last event, and no event of the key lies beyond that pane.
    """
    keys = names(keys)
    panes = df.groupBy(F.window(ts, slide, slide, start).alias("_pane"), *keys).agg(F.count(F.lit(1)).alias("_events"))
    newest = panes.groupBy(*keys).agg(F.max(F.struct(F.col("_pane.start").alias("window_start"), "_events")).alias("_newest"))
    return newest.select(*keys, "_newest.window_start", F.col("_newest._events").alias("total_count")).select(
        *keys, "window_start", _end(length), "total_count"
    )


def watchers_per_window(
    df: DataFrame,
    show: str = "show_id",
    user: str = "user_id",
    ts: str = "ts",
    length: str = LENGTH,
    slide: str = SLIDE,
    approx: bool = False,
) -> DataFrame:
    """Distinct users per show in each window. Streams need `approx`, which keeps a sketch per window and show."""
    if not approx and _has_panes(df, length, slide):
        sightings = df.where(F.col(user).isNotNull()).select(show, user, _pane(ts, slide))
        panes = _in_blocks(sightings, [show], length, slide).dropDuplicates([show, "_block", user, "_pane"])
        return (
            _copied(panes, length, slide)
            .groupBy(show, "_block", "window_start")
            .agg(F.count_distinct(user).alias("watchers"))
            .select(show, "window_start", _end(length), "watchers")
        )
    users = F.approx_count_distinct(user) if approx else F.count_distinct(user)
    counts = df.groupBy(F.window(ts, length, slide).alias("_window"), show).agg(users.alias("watchers"))
    return counts.select(
        show,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        "watchers",
    )
