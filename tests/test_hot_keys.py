"""Row-level totals must not depend on how a key is cut into blocks."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from showpulse.operators import blocks, dedup, totals
from showpulse.streaming import keyed
from showpulse.streaming.slots import one_per_slot

START = datetime(2024, 1, 1)


def brute_force(rows, gap=3600):
    """event_id -> (seen, running total of the user, running total since the user was last idle)."""
    last, total, idle, result = {}, {}, {}, {}
    for event_id, user, seconds in sorted(rows, key=lambda r: (r[2], r[0])):
        seen = user in last and seconds - last[user] <= gap
        last[user] = seconds
        # A null key is the key of no other event.
        total[user] = total.get(user, 0) + 1 if user else 1
        idle[user] = idle[user] + 1 if seen and user else 1
        result[event_id] = (seen, total[user], idle[user])
    return result


def skewed_rows(seed):
    """Two thirds of the rows belong to the hot user; half of those share one instant."""
    rng = random.Random(seed)
    rows = []
    for event_id in range(1200):
        kind = rng.random()
        if kind < 1 / 3:
            rows.append((event_id, "hot", 40_000))
        elif kind < 2 / 3:
            rows.append((event_id, "hot", rng.randrange(2_000_000)))
        else:
            rows.append((event_id, None if kind > 0.95 else f"u{rng.randrange(30)}", rng.randrange(200_000)))
    return rows


@pytest.fixture(scope="module", params=[1, 2])
def skewed(spark, request):
    rows = skewed_rows(request.param)
    data = [(i, u, START + timedelta(seconds=s)) for i, u, s in rows]
    df = spark.createDataFrame(data, "event_id long, user_id string, ts timestamp").repartition(8).cache()
    return df, brute_force(rows)


@pytest.mark.parametrize("rows_per_block", [2, 17, 400, 1_000_000])
def test_totals_and_flags(skewed, rows_per_block):
    df, expected = skewed
    flags = dedup.idle_gate(df, flag=True, rows_per_block=rows_per_block)
    total = totals.running_total(df, "user_id", rows_per_block=rows_per_block)
    idle = totals.running_total_idle(df, "user_id", rows_per_block=rows_per_block)
    assert {r.event_id: r.seen for r in flags.collect()} == {i: e[0] for i, e in expected.items()}
    assert {r.event_id: r.total_count for r in total.collect()} == {i: e[1] for i, e in expected.items()}
    assert {r.event_id: r.total_count for r in idle.collect()} == {i: e[2] for i, e in expected.items()}


def test_gate_without_flag_is_the_unseen_rows(skewed):
    df, expected = skewed
    kept = {r.event_id for r in dedup.idle_gate(df).collect()}
    assert kept == {i for i, e in expected.items() if not e[0]}


def test_hot_key_is_spread(skewed):
    df, _ = skewed
    rows = blocks.split_groups(df, ["user_id"], ["ts", "event_id"], rows_per_block=20).rows
    sizes = [r["count"] for r in rows.groupBy("user_id", "_block").count().collect()]
    assert sum(sizes) == 1200
    assert max(sizes) < 200


def test_blocks_follow_the_order(skewed):
    df, _ = skewed
    rows = blocks.split_groups(df, ["user_id"], ["ts", "event_id"], rows_per_block=5).rows.where("user_id = 'hot'")
    placed = [r._block for r in rows.orderBy("ts", "event_id").collect()]
    assert placed == sorted(placed)
    assert len(set(placed)) > 50


def test_deep_page_index(spark):
    """One key with far more pivots than fit one page."""
    df = spark.range(6000).select(
        F.col("id").alias("event_id"),
        F.lit("hot").alias("user_id"),
        F.timestamp_seconds(F.col("id") * 7).alias("ts"),
    )
    total = totals.running_total(df, "user_id", rows_per_block=1)
    assert total.where("total_count <> event_id + 1").count() == 0
    assert total.count() == 6000


def test_stream_holds_few_rows_of_a_hot_key(monkeypatch):
    """However many slot rows of a key one trigger brings, they are reduced as they come, and the first row of a slot stays."""
    monkeypatch.setattr(keyed, "ROWS_AT_ONCE", 5_000)
    rng = random.Random(4)
    width, frames, seen, most = 3_600_000_000, 60, [], 0
    shrink = one_per_slot("1 hour")

    def watched(rows):
        nonlocal most
        most = max(most, len(rows["key"]))
        return shrink(rows)

    def parts():
        for k in range(frames):
            rows = [(rng.randrange(20 * width), k * 1_000 + i) for i in range(1_000)]
            seen.extend(rows)
            times = [t for t, _ in rows]
            numbers = [i for _, i in rows]
            yield pd.DataFrame({"user_id": "hot", "event_id": numbers, "_first": times, "_last": times, "_events": 1})

    columns = ["user_id", "event_id", "_first", "_last", "_events"]
    got = shrink(keyed._gathered(parts(), columns, ["user_id"], ["_first", "event_id"], keyed.Numbers(), watched))
    slots = {}
    for t, i in seen:
        slots.setdefault(t // width, []).append((t, i))
    want = [(*min(rows), max(t for t, _ in rows), len(rows)) for _, rows in sorted(slots.items())]
    assert list(zip(*(got[name].tolist() for name in ("_first", "event_id", "_last", "_events")))) == want
    assert most <= 6_020


def test_stream_orders_null_before_others():
    exact = pd.Series([3, None, 2**53 + 1, 1], dtype=object)
    users = pd.Series([None, None, 2**53 + 1, 2**53], dtype=object)
    frame = pd.DataFrame({"u": users, "event_id": exact, "_first": 5})
    numbers = keyed.Numbers()
    got = keyed._gathered([frame], ["u", "event_id", "_first"], ["u"], ["_first", "event_id"], numbers, None)
    assert got["event_id"].tolist() == [None, 3, 2**53 + 1, 1]
    assert list(numbers) == [(None,), (2**53 + 1,), (2**53,)]
