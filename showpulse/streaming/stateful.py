"""The idle gate, the running total with idle reset and streaks of days: uses of keyed state.

An event older than the last sighting is a repeat: it starts no visit and does not move the last sighting back.
Events behind the watermark are dropped by Spark before they get here.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from showpulse.functions.durations import micros
from showpulse.operators.columns import names
from showpulse.operators.totals import KEYS
from showpulse.streaming.keyed import PAGES, Arrays, stateful_map
from showpulse.streaming.slots import one_per_slot, slot_rows

NEVER = np.iinfo(np.int64).min
DAY = 24 * 3600 * 1_000_000


def visit_starts(rows: Arrays, states: Arrays, width: int) -> np.ndarray:
    """Whether each slot row starts a visit, given when its key was last seen."""
    key, last = rows["key"], rows["_last"]
    n = len(key)
    # The latest time so far within each key, by places in the order of times.
    by = np.argsort(last, kind="stable")
    place = np.empty(n, np.int64)
    place[by] = np.arange(n)
    so_far = last[by][np.maximum.accumulate(place + key * n) - key * n]
    fresh = np.append(True, key[1:] != key[:-1])
    earlier = np.where(fresh, NEVER, np.append(NEVER, so_far[:-1]))
    previous = np.maximum(earlier, np.where(states["known"], states["seen"], NEVER)[key])
    return (previous == NEVER) | (rows["_first"] - np.where(previous == NEVER, 0, previous) > width)


def idle_gate_stream(
    df: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    order: str | list[str] = "event_id",
    gap: str = "3600 seconds",
    clock: str = "event",
    lateness: str = "0 seconds",
    pages: int = PAGES,
) -> DataFrame:
    """Events of users not seen for longer than `gap`, as a stream in append mode."""
    order, width, columns = names(order), micros(gap), df.columns

    def gate(keys: Arrays, rows: Arrays, states: Arrays) -> tuple[Arrays, Arrays]:
        starts = visit_starts(rows, states, width)
        return {name: rows[name][starts] for name in columns}, {}

    slots = slot_rows(df, [user], ts, gap, order)
    return stateful_map(
        slots, user, gate, T.StructType(), df.schema, "_first", order, gap, clock, lateness, "append", "_last",
        one_per_slot(gap), pages,
    )


def running_total_idle_stream(
    df: DataFrame,
    keys: str | list[str] = KEYS,
    ts: str = "ts",
    gap: str = "3600 seconds",
    clock: str = "event",
    lateness: str = "0 seconds",
    pages: int = PAGES,
) -> DataFrame:
    """Totals since a key was last idle longer than `gap`, as a stream in update mode.

    Each micro-batch gives one row for every visit it adds to: keys, `visit_start`, `visit_end` (last event so far)
    and `total_count`. The last row for a key and visit start does not depend on how the stream was cut into batches.
    """
    key_names, width = names(keys), micros(gap)

    def add_up(_: Arrays, rows: Arrays, states: Arrays) -> tuple[Arrays, Arrays]:
        key, starts = rows["key"], visit_starts(rows, states, width)
        fresh = np.append(True, key[1:] != key[:-1])
        visit = np.flatnonzero(starts | fresh)
        of = key[visit]
        goes_on = ~starts[visit]  # a key's first visit here goes on with the stored one
        start = np.where(goes_on, states["start"][of], rows["_first"][visit])
        end = np.maximum.reduceat(rows["_last"], visit)
        end = np.where(goes_on, np.maximum(states["seen"][of], end), end)
        events = np.add.reduceat(rows["_events"], visit) + np.where(goes_on, states["events"][of], 0)
        newest = np.append(of[1:] != of[:-1], True)
        made = {name: rows[name][visit] for name in key_names} | {"visit_start": start, "visit_end": end, "total_count": events}
        return made, {"start": start[newest], "events": events[newest]}

    slots = slot_rows(df.select(*key_names, ts), key_names, ts, gap, [])
    state = T.StructType([T.StructField("start", T.LongType()), T.StructField("events", T.LongType())])
    output = T.StructType(
        [
            *(df.schema[name] for name in key_names),
            T.StructField("visit_start", T.TimestampType()),
            T.StructField("visit_end", T.TimestampType()),
            T.StructField("total_count", T.LongType()),
        ]
    )
    return stateful_map(
        slots, key_names, add_up, state, output, "_first", [], gap, clock, lateness, "update", "_last",
        one_per_slot(gap), pages,
    )


def day_streaks_stream(df: DataFrame, user: str = "user_id", ts: str = "ts", pages: int = PAGES) -> DataFrame:
    """For each user of a micro-batch, days in a row with events up to the newest one (`days`) and at most so far
    (`longest_days`), as a stream in update mode. Days are those of UTC; an event of an earlier day than the newest counts
    only if its day is one that is counted already. State is three numbers per user and is never given up.
    """

    def streaks(keys: Arrays, rows: Arrays, states: Arrays) -> tuple[Arrays, Arrays]:
        key, day = rows["key"], rows["_first"] // DAY
        known, stored = states["known"][key], states["newest"][key]
        later = ~known | (day > stored)
        key, day = key[later], day[later]
        new = np.append(True, (key[1:] != key[:-1]) | (day[1:] != day[:-1]))[: len(key)]
        key, day = key[new], day[new]
        days, longest, newest = states["days"].copy(), states["longest"].copy(), states["newest"].copy()
        if len(key):
            fresh = np.append(True, key[1:] != key[:-1])
            previous = np.where(fresh, newest[key], np.append(0, day[:-1]))
            goes_on = (day - previous == 1) & (~fresh | states["known"][key])
            run = np.flatnonzero(~goes_on | fresh)
            length = np.diff(np.append(run, len(day))) + np.where(goes_on[run], days[key[run]], 0)
            np.maximum.at(longest, key[run], length)
            # Runs are in order, so a key's last one is what stays.
            days[key[run]], newest[key] = length, day
        made = {user: keys[user], "days": days, "longest_days": longest}
        return made, {"days": days, "longest": longest, "newest": newest}

    slots = slot_rows(df.select(user, ts), [user], ts, "1 day", [])
    state = T.StructType([T.StructField(name, T.LongType()) for name in ("days", "longest", "newest")])
    output = T.StructType([df.schema[user], *(T.StructField(name, T.LongType()) for name in ("days", "longest_days"))])
    return stateful_map(
        slots, user, streaks, state, output, "_first", gap=None, mode="update", shrink=one_per_slot("1 day"), pages=pages
    )
