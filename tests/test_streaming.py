import random

import pytest
from pyspark.sql import functions as F
from replay import Replay, at, seconds, table

from showpulse.operators import dedup, totals, windows
from showpulse.streaming import native, stateful


@pytest.fixture
def replay(spark, tmp_path):
    return Replay(spark, tmp_path)


def random_rows(seed, count=400, users=6, span=60_000):
    rng = random.Random(seed)
    times = sorted(rng.sample(range(span), count))
    return [(i, "hot" if rng.random() < 0.4 else f"u{rng.randrange(users)}", f"s{rng.randrange(3)}", t) for i, t in enumerate(times)]


def cut(rows, sizes):
    start = 0
    for size in sizes:
        yield rows[start : start + size]
        start += size
    yield rows[start:]


@pytest.mark.parametrize("sizes", [[], [150, 100], [1, 30, 200, 5]])
def test_gate_equals_batch_however_cut(spark, replay, sizes):
    rows = random_rows(1)
    for part in cut(rows, sizes):
        replay.add(part)
    batches = replay.run(stateful.idle_gate_stream(replay.stream()), "append")
    got = sorted(tuple(r) for b in batches for r in b)
    want = sorted(tuple(r) for r in dedup.idle_gate(table(spark, rows)).collect())
    assert got == want and len(want) > 20


@pytest.mark.parametrize("sizes", [[], [150, 100], [1, 30, 200, 5]])
def test_idle_total_equals_batch_however_cut(spark, replay, sizes):
    rows = random_rows(2)
    for part in cut(rows, sizes):
        replay.add(part)
    batches = replay.run(stateful.running_total_idle_stream(replay.stream()), "update")
    newest = {(r.user_id, r.show_id, r.visit_start): (r.visit_end, r.total_count) for b in batches for r in b}
    batch = totals.running_total_idle(table(spark, rows)).orderBy("ts").collect()
    visits, start = {}, {}
    for r in batch:
        key = (r.user_id, r.show_id)
        if r.total_count == 1:
            start[key] = r.ts
        visits[(*key, start[key])] = (r.ts, r.total_count)
    assert newest == visits and max(n for _, n in visits.values()) > 3


def test_each_batch_gives_touched_keys_only(replay):
    replay.add([(0, "a", "s", 0), (1, "b", "s", 1)])
    replay.add([(2, "b", "s", 2), (3, "b", "s", 3)])
    replay.add([(4, "a", "s", 4)])
    plain = replay.run(native.running_total_stream(replay.stream()), "update", "plain")
    idle = replay.run(stateful.running_total_idle_stream(replay.stream()), "update", "idle")
    expected = [{"a": 1, "b": 1}, {"b": 3}, {"a": 2}]
    assert [{r.user_id: r.total_count for r in b} for b in plain if b] == expected
    assert [{r.user_id: r.total_count for r in b} for b in idle if b] == expected


def test_restart_from_checkpoint(spark, replay):
    rows = random_rows(3)
    parts = list(cut(rows, [130, 120]))
    replay.add(parts[0])
    got = replay.run(stateful.idle_gate_stream(replay.stream()), "append")
    replay.add(parts[1])
    got += replay.run(stateful.idle_gate_stream(replay.stream()), "append")
    replay.add(parts[2])
    got += replay.run(stateful.idle_gate_stream(replay.stream()), "append")
    want = sorted(r.event_id for r in dedup.idle_gate(table(spark, rows)).collect())
    assert sorted(r.event_id for b in got for r in b) == want


def test_late_event_is_a_repeat(replay):
    replay.add([(0, "a", "s", 5000)])
    replay.add([(1, "a", "s", 100)])
    replay.add([(2, "a", "s", 8600)])
    replay.add([(3, "a", "s", 12_201)])
    batches = replay.run(stateful.idle_gate_stream(replay.stream(), lateness="2 hours"), "append")
    assert [r.event_id for b in batches for r in b] == [0, 3]


def test_gap_boundary_across_batches(replay):
    for i, t in enumerate([0, 3600, 7201]):
        replay.add([(i, "a", "s", t)])
    batches = replay.run(stateful.idle_gate_stream(replay.stream()), "append")
    assert [r.event_id for b in batches for r in b] == [0, 2]


def test_processing_clock_runs_on_arrival_times(replay):
    replay.add([(0, "a", "s", 0), (1, "a", "s", 10), (2, "b", "s", 5)])
    replay.add([(3, "a", "s", 20), (4, "c", "s", 21)])
    arrived = replay.stream().withColumn("arrived_at", F.current_timestamp())
    gate = stateful.idle_gate_stream(arrived, ts="arrived_at", clock="processing")
    assert sorted(r.event_id for b in replay.run(gate, "append", ends=False) for r in b) == [0, 2, 4]


def test_state_is_given_up_after_the_gap(spark, replay):
    for i in range(12):
        replay.add([(i, f"u{i}", "s", i * 2000)])
    gate = stateful.idle_gate_stream(replay.stream())
    query = (
        gate.writeStream.format("noop").trigger(availableNow=True)
        .option("checkpointLocation", str(replay.folder / "checkpoint")).start()
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 6


def test_windows_in_update_mode_equal_batch(spark, replay):
    rows = random_rows(4)
    for part in cut(rows, [100, 100]):
        replay.add(part)
    stream = windows.sliding_counts(replay.stream().withWatermark("ts", "10 minutes"))
    newest = {tuple(r)[:4]: r.total_count for b in replay.run(stream, "update") for r in b}
    assert newest == {tuple(r)[:4]: r.total_count for r in windows.sliding_counts(table(spark, rows)).collect()}


def test_windows_from_panes_of_a_stream_equal_batch(spark, replay):
    rows = random_rows(4)
    for part in cut(rows, [100, 100]):
        replay.add(part)
    panes = windows.pane_counts(replay.stream().withWatermark("ts", "10 minutes"), slide="30 seconds", start="7 seconds")
    newest = {tuple(r)[:3]: tuple(r) for b in replay.run(panes, "update") for r in b}
    kept = spark.createDataFrame(list(newest.values()), "user_id string, show_id string, window_start timestamp, total_count long")
    got = sorted(tuple(r) for r in windows.sliding_from_panes(kept).collect())
    assert got == sorted(tuple(r) for r in windows.sliding_counts(table(spark, rows), start="7 seconds").collect())
    with pytest.raises(ValueError):
        windows.sliding_from_panes(kept, length="100 seconds", slide="30 seconds")


def test_panes_shuffle_an_event_once_at_most(spark, replay):
    replay.add(random_rows(4))
    panes = windows.pane_counts(replay.stream().withWatermark("ts", "0 seconds"))
    query = panes.writeStream.outputMode("update").format("noop").trigger(availableNow=True)
    query = query.option("checkpointLocation", str(replay.folder / "c")).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "Expand" not in plan and plan.count("Exchange") == 1


def test_exact_watchers_from_first_sightings(spark, replay):
    """Events out of order, within the lateness and behind a restart, are counted once for each window."""
    rows = [(i, f"u{i % 5}", f"s{i % 2}", t) for i, t in enumerate([0, 10, 10, 29, 30, 95, 60, 61, 0, 160, 100, 100, 200, 130])]
    rows += [(99, None, "s0", 200), (100, "u1", None, 205)]
    got = []
    for part in cut(rows, [5, 4, 3]):
        replay.add(part)
        stream = windows.pane_watchers(replay.stream(), lateness="100 seconds")
        got += [tuple(r) for b in replay.run(stream, "append") for r in b]
    assert len(set(got)) == len(got)
    kept = spark.createDataFrame(got, "show_id string, user_id string, pane_start timestamp")
    want = windows.watchers_per_window(table(spark, rows)).collect()
    assert sorted(map(str, windows.watchers_from_panes(kept).collect())) == sorted(map(str, want))
    with pytest.raises(ValueError):
        windows.pane_watchers(replay.stream())


def test_watchers_sketch_on_stream(spark, replay):
    rows = random_rows(5)
    for part in cut(rows, [100, 100]):
        replay.add(part)
    stream = windows.watchers_per_window(replay.stream().withWatermark("ts", "1 hour"), approx=True)
    newest = {tuple(r)[:3]: r.watchers for b in replay.run(stream, "update") for r in b}
    assert newest == {tuple(r)[:3]: r.watchers for r in windows.watchers_per_window(table(spark, rows)).collect()}


def test_closed_sessions(spark, replay):
    rows = random_rows(6)
    for part in cut(rows, [150, 100]):
        replay.add(part)
    replay.add([(9999, "end", "s", 900_000)])
    closed = replay.run(native.session_first_stream(replay.stream()), "append")
    got = sorted(tuple(r) for b in closed for r in b)
    assert got == sorted(tuple(r) for r in dedup.session_first(table(spark, rows)).collect())


def test_state_keeps_payload_exact(spark, replay):
    """Payload columns with nulls and large integers pass the gate unchanged."""
    replay.add([(9007199254740993, "a", None, 0), (2, None, "s", 0), (3, None, "s", 9)])
    kept = [tuple(r) for b in replay.run(stateful.idle_gate_stream(replay.stream()), "append") for r in b]
    assert sorted(kept, key=str) == sorted([(9007199254740993, "a", None, at(0)), (2, None, "s", at(0))], key=str)
    assert seconds(kept[0][3]) == 0
