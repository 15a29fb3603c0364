"""Hand-written rows for the boundaries of each operator."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from replay import at, seconds, table

from showpulse.functions import codec, keytext
from showpulse.operators import counts, dedup, totals, views, windows
from showpulse.operators.latest import latest
from showpulse.sources import files
from showpulse.sources.shared import shared_folder
from showpulse.streaming import sinks


def ids(df):
    return sorted(r.event_id for r in df.collect())


def sightings(spark, times, user="u", show="s"):
    return table(spark, [(i, user, show, t) for i, t in enumerate(times)])


def test_gap_must_be_exceeded(spark):
    df = sightings(spark, [0, 3600, 7201])
    assert ids(dedup.idle_gate(df)) == [0, 2]
    assert ids(dedup.idle_gate(df, flag=True).where("NOT seen")) == [0, 2]
    assert ids(dedup.session_first(df)) == [0, 2]


def test_repeats_refresh_the_gap(spark):
    assert ids(dedup.idle_gate(sightings(spark, [0, 3000, 6000, 9000]))) == [0]


def test_visits_with_end_and_size(spark):
    rows = dedup.session_first(sightings(spark, [0, 10, 3500, 7200, 10_801])).orderBy("ts").collect()
    assert [(r.event_id, seconds(r.visit_end), r.visit_events) for r in rows] == [(0, 3500, 3), (3, 7200, 1), (4, 10_801, 1)]


def test_times_before_the_epoch(spark):
    rows = [(i, "u", "s", datetime(1969, 12, 31, 20, 0, i * 20)) for i in range(3)]
    df = spark.createDataFrame(rows, "event_id long, user_id string, show_id string, ts timestamp")
    assert ids(dedup.idle_gate(df, gap="15 seconds")) == [0, 1, 2]
    assert ids(dedup.idle_gate(df, gap="20 seconds")) == [0]


def test_idle_reset(spark):
    df = sightings(spark, [0, 10, 4000])
    in_order = lambda result: [r.total_count for r in result.orderBy("event_id").collect()]
    assert in_order(totals.running_total_idle(df)) == [1, 2, 1]
    assert in_order(totals.running_total(df)) == [1, 2, 3]


def test_event_belongs_to_five_windows(spark):
    rows = windows.sliding_counts(sightings(spark, [60])).orderBy("window_start").collect()
    assert [seconds(r.window_start) for r in rows] == [-60, -30, 0, 30, 60]
    assert all((r.window_end - r.window_start).total_seconds() == 150 for r in rows)


def test_window_start_shifts(spark):
    rows = windows.sliding_counts(sightings(spark, [60]), start="10 seconds").orderBy("window_start").collect()
    assert [seconds(r.window_start) for r in rows] == [-80, -50, -20, 10, 40]


def test_two_shows_one_user(spark):
    df = totals.running_total(table(spark, [(0, "u", "a", 0), (1, "u", "b", 1)]))
    assert latest(df, "user_id", ["ts", "event_id"]).select("show_id").collect() == [("b",)]
    assert latest(df, ["user_id", "show_id"], ["ts", "event_id"]).count() == 2


def test_newest_totals_are_the_last_running_totals(spark):
    rows = [(i, f"u{i % 3}", f"s{i % 2}", (i * 37) % 50) for i in range(60)]
    df = table(spark, rows)
    for by in ("user_id", ["user_id", "show_id"]):
        expected = latest(totals.running_total(df), by, ["ts", "event_id"])
        got = totals.newest_totals(df, by=by).select(*expected.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_first_per_batch_takes_the_earliest(spark):
    df = table(spark, [(5, "u", "a", 1.5), (4, "u", "b", 1.5), (1, "u", "c", 4.9), (2, "u", "d", 5.0)])
    assert ids(dedup.first_per_batch(df)) == [2, 4]


def test_updates_per_batch(spark):
    df = sightings(spark, [0, 1, 7, 21])
    rows = totals.running_total_updates(df).orderBy("batch_start").collect()
    assert [(seconds(r.batch_start), r.batch_count, r.total_count) for r in rows] == [(0, 2, 2), (5, 1, 3), (20, 1, 4)]


def test_colliding_text_keys_stay_apart(spark):
    df = table(spark, [(0, "1", "23", 0), (1, "12", "3", 0), (2, "12", "3", 1)])
    rows = sorted(tuple(r) for r in counts.view_counts(df).collect())
    assert rows == [("123", "1", "23", 1), ("123", "12", "3", 2)]
    lines = sorted(r.value for r in counts.pair_lines(counts.view_counts(df), "count_key", "view_count").collect())
    assert lines == ["(123,1)", "(123,2)"]


def test_count_lines_and_tables_on_disk(spark, tmp_path):
    df = counts.view_counts(table(spark, [(0, "u", "a", 0), (1, "u", "a", 1)]))
    sinks.write_pairs_text(df, "count_key", "view_count", str(tmp_path / "lines"))
    sinks.write_counts(df, str(tmp_path / "counts"))
    sinks.write_counts(df, str(tmp_path / "counts"))
    assert spark.read.text(str(tmp_path / "lines")).collect() == [("(ua,2)",)]
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "counts")).collect()] == [("ua", "u", "a", 2)]


def test_watchers(spark):
    df = table(spark, [(0, "u", "a", 0), (1, "u", "a", 1), (2, "v", "a", 2), (3, "v", "b", 2)])
    assert sorted(map(tuple, counts.watchers_per_show(df).collect())) == [("a", 2), ("b", 1)]
    assert sorted(map(tuple, counts.watchers_per_show(df, approx=True).collect())) == [("a", 2), ("b", 1)]
    assert sorted(map(tuple, counts.views_per_show(df).collect())) == [("a", 3), ("b", 1)]
    assert counts.group_count(df).collect() == [(3,)]


# --- messages -----------------------------------------------------------------------------------------------------

GOOD = {
    "userId": "u", "userGender": "Male", "season": "1", "episode": "2", "showId": "Dexter",
    "timestamp": "2024-01-01 00:00:00", "rating": 4.5, "episodeLength": 45.0,
}


def decode(spark, *messages):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "n int, value string")
    good, bad = codec.decode_events(df)
    return {r.n: r for r in good.collect()}, {r.n: r.value for r in bad.collect()}


def message(**changes):
    return json.dumps({k: v for k, v in (GOOD | changes).items() if v is not ...})


def test_zone_of_messages(spark):
    good, bad = decode(spark, message())
    assert not bad
    assert good[0].event_time == datetime(2024, 1, 1, 7)
    assert (good[0].user_id, good[0].show_id, good[0].rating, good[0].episode_length) == ("u", "Dexter", 4.5, 45.0)


@pytest.mark.parametrize("text", ["not json", "", "null", "[]", "[1]", "7", '{"userId": "u"', None])
def test_unreadable_messages_are_kept_aside(spark, text):
    good, bad = decode(spark, message(), text)
    assert list(good) == [0] and bad == {1: text}


def test_unreadable_fields_are_kept_aside(spark):
    good, bad = decode(spark, message(timestamp="yesterday"), message(rating="high"), message(episodeLength="long"))
    assert not good and len(bad) == 3


def test_tolerated_fields(spark):
    good, bad = decode(
        spark,
        message(rating="4.5"),
        message(rating=...),
        message(rating=None, episodeLength=""),
        message(extra=1),
        message(timestamp=None),
        message(userAge="30", showName="Dexter, season 1"),
        message(season=1),
    )
    assert not bad
    assert [good[i].rating for i in range(3)] == [4.5, 0.0, 0.0]
    assert good[2].episode_length == 0.0
    assert good[4].event_time is None
    assert (good[5].user_age, good[5].show_name) == ("30", "Dexter, season 1")
    assert good[6].season == "1"


def test_times_as_numbers(spark):
    """Milliseconds since 1970 have no zone; more than 15 digits are no time."""
    good, bad = decode(spark, message(timestamp=1704067200123), message(timestamp="-1000"), message(timestamp=10**17))
    assert [good[i].event_time for i in (0, 1)] == [datetime(2024, 1, 1, 0, 0, 0, 123_000), datetime(1969, 12, 31, 23, 59, 59)]
    assert list(bad) == [2]


def test_message_bytes(spark):
    df = spark.createDataFrame([(bytearray(message().encode()),)], "value binary")
    good, bad = codec.decode_events(df)
    assert good.count() == 1 and bad.count() == 0


def test_encoded_message(spark):
    good, _ = codec.decode_events(spark.createDataFrame([(message(userGender=None),)], "value string"))
    (row,) = codec.encode_events(good).collect()
    assert json.loads(row.value) == GOOD | {"userGender": None}
    assert list(json.loads(row.value)) == list(GOOD)


# --- stored views -------------------------------------------------------------------------------------------------

WATCHED = "event_id long, user_id string, user_gender string, season string, episode string, show_id string, event_time timestamp, rating double, episode_length double"


def watched(spark, *rows):
    return spark.createDataFrame(rows, WATCHED)


def test_incomplete_views_are_rejected(spark, tmp_path):
    df = watched(
        spark,
        (0, "u", None, "1", "2", "s", at(0), 1.0, 30.0),
        (1, None, "Male", "1", "2", "s", at(0), 1.0, 30.0),
        (2, "u", "Male", None, "2", "s", at(0), 1.0, 30.0),
        (3, "u", "Male", "1", None, "s", at(0), 1.0, 30.0),
        (4, "u", "Male", "1", "2", None, at(0), 1.0, 30.0),
    )
    sinks.append_views(df, 3, str(tmp_path / "view"), rejected=str(tmp_path / "rejected"))
    assert sinks.stored_views(spark, str(tmp_path / "view")).count() == 1
    assert ids(spark.read.parquet(str(tmp_path / "rejected"))) == [1, 2, 3, 4]


def test_retried_batch_replaces_itself(spark, tmp_path):
    df = watched(spark, (0, "u", "Male", "1", "2", "s", at(0), 1.0, 30.0))
    for batch_id in (0, 1, 1):
        sinks.append_views(df, batch_id, str(tmp_path / "view"))
    assert sinks.stored_views(spark, str(tmp_path / "view")).count() == 2


def test_bulk_load_writes_few_files(spark, tmp_path):
    rows = [(i, f"u{i}", "Male", "1", "2", "s", at(86_400 * (i % 3)), 1.0, 30.0) for i in range(90)]
    sinks.append_views(watched(spark, *rows).repartition(8), 0, str(tmp_path / "view"), written_at=F.col("event_time"))
    assert sinks.stored_views(spark, str(tmp_path / "view")).count() == 90
    assert len(list((tmp_path / "view").glob("log/*/*/*.parquet"))) == 3


def test_same_second(spark, tmp_path):
    df = watched(
        spark,
        (0, "u", "Male", "1", "2", "s", at(0.1), 1.0, 30.0),
        (1, "u", "Male", "1", "3", "s", at(0.9), 1.0, 30.0),
    )
    stamp = F.col("event_time")
    sinks.append_views(df, 0, str(tmp_path / "all"), written_at=stamp)
    sinks.append_views(df, 0, str(tmp_path / "last"), written_at=stamp, dedup="user_second")
    assert sinks.stored_views(spark, str(tmp_path / "all")).count() == 2
    (row,) = sinks.stored_views(spark, str(tmp_path / "last")).collect()
    assert row.watchedEpisode.Episode == "3"


def test_view_roundtrips(spark):
    df = watched(spark, (0, "u", None, "1", "2", "s", at(7), 4.5, 30.0))
    rows = views.view_rows(df, F.col("event_time"))
    assert rows.first().row_key == "u;Mon Jan 01 00:00:07 UTC 2024"
    (nested,) = views.views_to_events(rows).collect()
    assert (nested.user_id, nested.user_gender, nested.event_time, nested.rating) == ("u", None, at(7), 4.5)
    (cells,) = views.cells_to_events(views.view_cells(rows)).collect()
    assert (cells.user_id, cells.user_gender, cells.written_at, cells.rating) == ("u", "null", at(7), 4.5)


def test_missing_number_cell(spark):
    df = spark.createDataFrame([(bytearray(b"null"),), (bytearray(b"4.5"),), (None,)], "c binary")
    assert [r.n for r in df.select(keytext.cell_number(F.col("c")).alias("n")).collect()] == [None, 4.5, None]


def test_stored_count_rows(spark):
    df = totals.running_total_updates(sightings(spark, [0, 86_400]))
    rows = views.traffic_rows(df, F.col("batch_start")).orderBy("time_stamp").collect()
    assert [(r.total_count, r.record_date) for r in rows] == [(1, "2024-01-01"), (2, "2024-01-02")]
    assert views.traffic_rows(df).where("time_stamp IS NOT NULL").count() == 2


# --- files --------------------------------------------------------------------------------------------------------


def test_messages_in_files(spark, tmp_path):
    good, _ = codec.decode_events(spark.createDataFrame([(message(),), (message(userId="v"),)], "value string"))
    published = str(tmp_path / "messages")
    files.publish_files(codec.encode_events(good), published)
    stream = files.file_events(spark, published, "value string", "text")
    again = files.publish_files(stream, str(tmp_path / "copy"), str(tmp_path / "checkpoint"))
    again.processAllAvailable()
    again.stop()
    copied, bad = codec.decode_events(spark.read.text(str(tmp_path / "copy")))
    assert bad.count() == 0
    assert sorted(map(tuple, copied.collect())) == sorted(map(tuple, good.collect()))


def test_shared_folder_is_below_the_checkpoint_setting(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) != shared_folder(spark)


def test_counting_reads_two_nested_columns_only(spark, tmp_path):
    df = watched(spark, (0, "u", "Male", "1", "2", "s", at(0), 1.0, 30.0))
    sinks.append_views(df, 0, str(tmp_path / "view"))
    stored = sinks.stored_views(spark, str(tmp_path / "view"))
    plan = counts.view_counts(views.views_to_events(stored))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<watchedEpisode:struct<ShowId:string>,userDetails:struct<userId:string>>" in plan
