"""The whole streaming job and batch job, over messages that arrive in several files."""

import json
import time
from collections import Counter
from datetime import timezone

import pytest
from replay import Replay, at

from showpulse.operators.windows import pane_counts
from showpulse.plans.jobs import LateRows, batch_job, latest_stamp, streaming_job
from showpulse.streaming import sinks, tables

NOW = {"availableNow": True}


def message(user, show, seconds, **more):
    return json.dumps(
        {"userId": user, "userGender": "Male", "season": "1", "episode": "2", "showId": show,
         "timestamp": str(at(seconds)), "rating": 4.5, "episodeLength": 45.0} | more
    )


FIRST = [message("u", "a", 0), message("v", "a", 5), "broken", message("u", "b", 10)]
SECOND = [message("u", "a", 20), message("w", "b", 30), message("w", None, 31)]
THIRD = [message("u", "b", 4000), message("v", "a", 4001), message("u", "b", 4002), "{"]


class Inbox:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, folder, 0

    def send(self, messages):
        lines = [json.dumps({"value": m, "n": self.sent + i}) for i, m in enumerate(messages)]
        self.sent += len(lines)
        (self.folder / "in").mkdir(exist_ok=True)
        (self.folder / "in" / f"{self.sent:05d}.json").write_text("\n".join(lines))

    def run(self, **options):
        options = {"clock": "event", "lateness": "0 seconds"} | options
        messages = self.spark.readStream.schema("value string, n long").json(str(self.folder / "in"))
        streaming_job(self.spark, messages, str(self.folder / "out"), str(self.folder / "checkpoint"), NOW, order="n", **options)

    def table(self, name):
        if name == "view":
            return sinks.stored_views(self.spark, str(self.folder / "out" / "view"))
        return self.spark.read.parquet(str(self.folder / "out" / name))

    def upserts(self, name, keys, order="batch_id"):
        return sinks.upserted(self.spark, str(self.folder / "out" / name), keys, order)


def test_gated_job_with_restart(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    for part in (FIRST, SECOND, THIRD):
        inbox.send(part)
        inbox.run()
    assert inbox.table("view").count() == 8
    assert sorted(r.value for r in inbox.table("quarantine").collect()) == ["broken", "{"]
    assert [r.user_id for r in inbox.table("rejected").collect()] == ["w"]
    gated = sorted((r.user_id, r.show_id) for r in inbox.table("gated").collect())
    assert gated == [("u", "a"), ("u", "b"), ("v", "a"), ("v", "a"), ("w", "b")]
    totals = inbox.upserts("total_traffic", ["user_id", "show_id", "visit_start"]).collect()
    assert Counter((r.user_id, r.show_id, r.total_count) for r in totals) == Counter(
        {("u", "a", 1): 1, ("u", "b", 1): 1, ("v", "a", 1): 2, ("w", "b", 1): 1}
    )
    windows = sinks.read_sliding(spark, str(tmp_path / "out" / "window_traffic")).collect()
    assert {r.total_count for r in windows} == {1} and len(windows) == 25
    watchers = sinks.read_watchers(spark, str(tmp_path / "out" / "watchers")).collect()
    assert {r.show_id: r.watchers for r in watchers} == {"a": 2, "b": 2}

    batch_job(spark, str(tmp_path / "out" / "view"), str(tmp_path / "out")).show()
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out" / "batchResult.txt")).collect())
    assert lines == ["(ua,2)", "(ub,3)", "(va,2)", "(wb,1)"]


def test_ungated_job_counts_every_view(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send(FIRST + SECOND)
    inbox.run(gated=False)
    inbox.send(THIRD)
    inbox.run(gated=False)
    totals = inbox.upserts("total_traffic", ["user_id", "show_id"], "visit_end").collect()
    assert {(r.user_id, r.show_id): r.total_count for r in totals} == {
        ("u", "a"): 2, ("u", "b"): 2, ("v", "a"): 1, ("w", "b"): 1,
    }
    by_user = inbox.upserts("total_traffic", "user_id", ["visit_end", "show_id"]).collect()
    assert {r.user_id: (r.show_id, r.total_count) for r in by_user} == {"u": ("b", 2), "v": ("a", 1), "w": ("b", 1)}
    windows = sinks.read_sliding(spark, str(tmp_path / "out" / "window_traffic"))
    assert windows.agg({"total_count": "max"}).first()[0] == 2


def test_event_clock_needs_lateness(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send(FIRST)
    with pytest.raises(ValueError):
        inbox.run(lateness=None)
    with pytest.raises(ValueError):
        inbox.run(clock="wall")


def test_nothing_is_lost_by_arrival(spark, tmp_path):
    """Newer events first, and one without a time: all are counted."""
    inbox = Inbox(spark, tmp_path)
    untimed = json.dumps({k: v for k, v in json.loads(message("x", "a", 0)).items() if k != "timestamp"})
    for part in (THIRD, SECOND, [*FIRST, untimed]):
        inbox.send(part)
        inbox.run(clock="arrival", gated=False)
    visits = inbox.upserts("total_traffic", ["user_id", "show_id", "visit_start"], "visit_end").collect()
    totals = Counter()
    for r in visits:
        totals[r.user_id, r.show_id] += r.total_count
    assert totals == {("u", "a"): 2, ("u", "b"): 3, ("v", "a"): 2, ("w", "b"): 1, ("x", "a"): 1}
    assert inbox.table("view").count() == 9


def test_late_events_fail_the_job(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send(THIRD)
    inbox.run()
    inbox.send(FIRST)
    with pytest.raises(RuntimeError, match="later than"):
        inbox.run()


def test_untimed_events_are_rejected_by_the_event_clock(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send([json.dumps({k: v for k, v in json.loads(message("x", "a", 0)).items() if k != "timestamp"}), *FIRST])
    inbox.run()
    assert [r.user_id for r in inbox.table("rejected").collect()] == ["x"]


def test_tables_are_merged_by_the_job(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    for part in (FIRST, SECOND, THIRD):
        inbox.send(part)
        inbox.run(gated=False, merge_every=1)
    out = tmp_path / "out"
    for name in ("view", "watchers", "total_traffic", "window_traffic"):
        commit = tables.newest_commit(spark, str(out / name))
        assert commit.number >= 2 and not tables.unmerged(spark, str(out / name), commit)
    assert inbox.table("view").count() == 8
    totals = inbox.upserts("total_traffic", ["user_id", "show_id"], "visit_end").collect()
    assert {(r.user_id, r.show_id): r.total_count for r in totals} == {
        ("u", "a"): 2, ("u", "b"): 2, ("v", "a"): 1, ("w", "b"): 1,
    }


def test_each_message_is_parsed_once(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    inbox.send(FIRST)
    messages = spark.readStream.schema("value string, n long").json(str(tmp_path / "in"))
    folders = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    queries = streaming_job(spark, messages, *folders, NOW, order="n", clock="event", lateness="0 seconds", gated=False)
    plans = [query._jsq.explainInternal(False) for query in queries]
    assert len(plans) == 4
    assert ["from_json" in plan or "FileScan json" in plan for plan in plans] == [True, False, False, False]


def test_consumers_go_on_by_themselves_after_a_crash(spark, tmp_path, monkeypatch):
    """Totals fail in the second run, after the views of that run were stored; the next run makes up for it."""
    inbox = Inbox(spark, tmp_path)
    inbox.send(FIRST)
    inbox.run(gated=False)
    inbox.send(SECOND)
    whole = sinks.upsert_log

    def failing(batch, batch_id, path):
        if path.endswith("total_traffic"):
            raise RuntimeError("lost")
        whole(batch, batch_id, path)

    monkeypatch.setattr(sinks, "upsert_log", failing)
    with pytest.raises(Exception, match="lost"):
        inbox.run(gated=False)
    assert inbox.table("view").count() == 5
    monkeypatch.setattr(sinks, "upsert_log", whole)
    inbox.send(THIRD)
    inbox.run(gated=False)
    assert inbox.table("view").count() == 8
    totals = inbox.upserts("total_traffic", ["user_id", "show_id"], "visit_end").collect()
    assert {(r.user_id, r.show_id): r.total_count for r in totals} == {
        ("u", "a"): 2, ("u", "b"): 2, ("v", "a"): 1, ("w", "b"): 1,
    }
    assert sorted(r.value for r in inbox.table("quarantine").collect()) == ["broken", "{"]


def test_arrival_stamps_never_go_back(spark, tmp_path):
    """An earlier start has noted a time far ahead of this machine's clock."""
    inbox = Inbox(spark, tmp_path)
    ahead = int(time.time() * 1000) + 10**9
    note = tmp_path / "checkpoint" / "decoded-stamps"
    note.mkdir(parents=True)
    (note / str(ahead)).touch()
    for part in (FIRST, SECOND, THIRD):
        inbox.send(part)
        inbox.run(clock="arrival", gated=False)
    stamps = {r[0].replace(tzinfo=timezone.utc).timestamp() for r in inbox.table("decoded").select("counted_at").collect()}
    assert stamps == {ahead / 1000}
    visits = inbox.upserts("total_traffic", ["user_id", "show_id"], "visit_end").collect()
    assert {(r.user_id, r.show_id): r.total_count for r in visits} == {
        ("u", "a"): 2, ("u", "b"): 3, ("v", "a"): 2, ("w", "b"): 1,
    }
    (tmp_path / "other" / "offsets").mkdir(parents=True)
    for n, at_ms in enumerate((5, 9, 7)):
        (tmp_path / "other" / "offsets" / str(n)).write_text(f'v1\n{{"batchWatermarkMs":99,"batchTimestampMs":{at_ms}}}\n3\n')
    assert latest_stamp(spark, str(tmp_path / "other")) == 9
    (tmp_path / "other" / "offsets" / "1").unlink()
    assert latest_stamp(spark, str(tmp_path / "other")) == 9


def test_late_rows_of_every_batch_are_counted(spark, tmp_path):
    """More batches than a query remembers."""
    remembered = "spark.sql.streaming.numRecentProgressUpdates"
    replay = Replay(spark, tmp_path)
    replay.add([(0, "a", "s", 90_000)])
    for i in range(4):
        replay.add([(i, "a", "s", i), (i, "b", "s", i)])
    late = LateRows()
    spark.conf.set(remembered, "1")
    spark.streams.addListener(late)
    try:
        panes = pane_counts(replay.stream().withWatermark("ts", "0 seconds"))
        query = panes.writeStream.outputMode("update").format("noop").trigger(availableNow=True)
        query = query.option("checkpointLocation", str(tmp_path / "c")).start()
        query.awaitTermination()
        # Late rows are told by the watermark of the batch before, so the first of the four batches drops none.
        assert late.total([query]) == 6 > sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    finally:
        spark.streams.removeListener(late)
        spark.conf.unset(remembered)


def test_reads_take_the_newest_batch_of_equal_rows(spark, tmp_path):
    schema = "user_id string, show_id string, window_start timestamp, total_count int"
    for batch, count in enumerate((1, 2, 3)):
        rows = [(f"u{i}", "s", at(w), count) for i in range(200) for w in (0, 30)]
        sinks.upsert_log(spark.createDataFrame(rows, schema), batch, str(tmp_path / "t"))
    keys = ["user_id", "show_id"]
    got = lambda: {(r.window_end, r.total_count) for r in sinks.read_windows(spark, str(tmp_path / "t"), keys).collect()}
    assert got() == {(at(180), 3)}
    with pytest.raises(ValueError):
        sinks.merge_upserts(spark, str(tmp_path / "t"), keys)
    sinks.merge_upserts(spark, str(tmp_path / "t"), sinks.PANE)
    assert got() == {(at(180), 3)}


def test_job_that_keeps_running(spark, tmp_path):
    """All four queries start together, before the gate has written anything."""
    inbox = Inbox(spark, tmp_path)
    inbox.send(FIRST)
    messages = spark.readStream.schema("value string, n long").json(str(tmp_path / "in"))
    out = tmp_path / "out"
    queries = streaming_job(
        spark, messages, str(out), str(tmp_path / "checkpoint"), {"processingTime": "1 second"}, order="n",
        clock="event", lateness="0 seconds",
    )
    try:
        deadline = time.monotonic() + 90
        done = [out / "total_traffic" / "log", out / "window_traffic" / "log"]
        while time.monotonic() < deadline and all(q.isActive for q in queries):
            if all(list(log.glob("*/_SUCCESS")) for log in done):
                break
            time.sleep(0.5)
    finally:
        for query in queries:
            query.stop()
    assert all(query.exception() is None for query in queries)
    totals = inbox.upserts("total_traffic", ["user_id", "show_id"]).collect()
    assert {(r.user_id, r.show_id, r.total_count) for r in totals} == {("u", "a", 1), ("v", "a", 1)}
