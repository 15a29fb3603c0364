"""Merged tables: readers see each batch once, whatever is retried, merged or deleted around them."""

import json

import pytest
from pyspark.sql import functions as F
from replay import at, table

from showpulse.operators import sketches, windows
from showpulse.streaming import sinks, tables

EVENTS = "event_id long, user_id string, user_gender string, season string, episode string, show_id string, event_time timestamp, rating double, episode_length double"


def views_of(spark, days, start=0):
    rows = [(start + i, f"u{i}", "Male", "1", "2", "s", at(86_400 * d), 1.0, 30.0) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, EVENTS)


def add(spark, path, batch_id, days):
    sinks.append_views(views_of(spark, days), batch_id, path, written_at=F.col("event_time"))


def dates(spark, path, only=None):
    found = sinks.stored_views(spark, path, only).groupBy("record_date").count().collect()
    return {r.record_date[-2:]: r["count"] for r in found}


def test_views_by_date(spark, tmp_path):
    path = str(tmp_path / "view")
    assert dates(spark, path) == {}
    add(spark, path, 0, [0, 0, 1])
    add(spark, path, 1, [1, 2])
    sinks.merge_views(spark, path)
    first = tables.newest_commit(spark, path)
    add(spark, path, 2, [2, 2])
    assert dates(spark, path) == {"01": 2, "02": 2, "03": 3}
    sinks.merge_views(spark, path)
    second = tables.newest_commit(spark, path)
    assert dates(spark, path) == {"01": 2, "02": 2, "03": 3}
    changed = {date for date in second.parts if second.parts[date] != first.parts.get(date)}
    assert changed == {"2024-01-03"} and second.holds == [[0, 2]]
    sinks.merge_views(spark, path)
    assert tables.newest_commit(spark, path) == second


def test_a_date_lists_its_own_folders_only(spark, tmp_path):
    path = str(tmp_path / "view")
    add(spark, path, 0, [0, 1, 2])
    sinks.merge_views(spark, path)
    add(spark, path, 1, [1, 3])
    found = sinks.stored_views(spark, path, ["2024-01-02"])
    assert found.count() == 2
    assert found.inputFiles() and all("record_date=2024-01-02" in file for file in found.inputFiles())
    assert dates(spark, path, ["2024-01-01", "2024-01-04"]) == {"01": 1, "04": 1}
    assert dates(spark, path, ["2025-01-01"]) == {}


def test_a_batch_retried_after_its_merge_counts_once(spark, tmp_path):
    path = str(tmp_path / "view")
    add(spark, path, 0, [0, 1])
    sinks.merge_views(spark, path)
    add(spark, path, 0, [0, 1])
    add(spark, path, 1, [1])
    assert dates(spark, path) == {"01": 1, "02": 2}
    sinks.merge_views(spark, path)
    assert dates(spark, path) == {"01": 1, "02": 2}


def test_batches_that_come_during_a_merge_stay_visible(spark, tmp_path):
    path = str(tmp_path / "view")
    add(spark, path, 0, [0, 1])
    add(spark, path, 3, [1])

    def while_it_runs(rows):
        add(spark, path, 2, [0])
        return rows

    tables.merge(spark, path, "record_date", while_it_runs, schema=sinks.VIEW)
    assert tables.newest_commit(spark, path).holds == [[0, 0], [3, 3]]
    assert dates(spark, path) == {"01": 2, "02": 2}
    sinks.merge_views(spark, path)
    assert tables.newest_commit(spark, path).holds == [[0, 0], [2, 3]]
    assert dates(spark, path) == {"01": 2, "02": 2}


def test_of_two_merges_at_once_one_fails_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "view")
    add(spark, path, 0, [0, 1])

    def another(rows):
        sinks.merge_views(spark, path)
        return rows

    with pytest.raises(Exception, match="(?i)exist"):
        tables.merge(spark, path, "record_date", another, schema=sinks.VIEW)
    assert tables.newest_commit(spark, path).number == 0
    assert dates(spark, path) == {"01": 1, "02": 1}


def test_a_merge_that_fails_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "view")
    add(spark, path, 0, [0])
    with pytest.raises(Exception):
        tables.merge(spark, path, "record_date", lambda rows: rows.select(F.raise_error(F.lit("lost")), "*"), schema=sinks.VIEW)
    assert tables.newest_commit(spark, path).number == -1
    assert dates(spark, path) == {"01": 1}


def test_readers_outlive_merge_and_purge(spark, tmp_path):
    path = str(tmp_path / "view")
    add(spark, path, 0, [0, 1])
    sinks.merge_views(spark, path)
    add(spark, path, 1, [1])
    planned = sinks.stored_views(spark, path)
    sinks.merge_views(spark, path)
    tables.purge(spark, path)
    assert planned.count() == 3  # planned by the record before the newest
    add(spark, path, 2, [1])
    sinks.merge_views(spark, path)
    tables.purge(spark, path)
    assert dates(spark, path) == {"01": 1, "02": 3}
    assert sorted(p.name for p in (tmp_path / "view" / "commits").glob("[0-9]*.json")) == ["1.json", "2.json"]
    assert sorted(p.name for p in (tmp_path / "view" / "log").glob("batch_id=*")) == ["batch_id=2"]
    # The first write still holds the date that was not touched since.
    needed = {f.split("/")[1] for f in json.loads((tmp_path / "view" / "commits" / "2.json").read_text())["parts"].values()}
    assert needed <= {p.name for p in (tmp_path / "view" / "parts").iterdir()}


def upserts(spark, path, values, batch_id):
    sinks.upsert_log(spark.createDataFrame(values, "user_id string, show_id string, total_count long"), batch_id, path)


def test_upserts_by_key_bucket(spark, tmp_path):
    path, keys = str(tmp_path / "traffic"), ["user_id", "show_id"]

    def rows(by=keys):
        found = sinks.upserted(spark, path, by).select(*keys, "total_count").collect()
        return sorted(tuple(r) for r in found)

    with pytest.raises(ValueError):
        rows()
    upserts(spark, path, [("u", "a", 1), ("v", "a", 1)], 0)
    upserts(spark, path, [("u", "b", 7)], 1)
    upserts(spark, path, [("u", "b", 1)], 1)
    want = [("u", "a", 1), ("u", "b", 1), ("v", "a", 1)]
    assert rows() == want
    sinks.merge_upserts(spark, path, keys)
    first = tables.newest_commit(spark, path)
    assert rows() == want and rows("user_id") == [("u", "b", 1), ("v", "a", 1)]
    upserts(spark, path, [("u", "a", 2)], 2)
    assert rows() == [("u", "a", 2), *want[1:]]
    sinks.merge_upserts(spark, path, keys)
    second = tables.newest_commit(spark, path)
    assert sum(second.parts[b] != first.parts[b] for b in first.parts) == 1
    tables.purge(spark, path)
    assert rows() == [("u", "a", 2), *want[1:]] and rows("user_id") == [("u", "a", 2), ("v", "a", 1)]
    upserts(spark, path, [("u", "a", 0)], 1)  # an old batch that is retried
    assert rows() == [("u", "a", 2), *want[1:]]
    upserts(spark, path, [("u", None, 5), (None, "a", 6)], 3)
    sinks.merge_upserts(spark, path, keys)
    assert sorted(map(str, rows_of(spark, path, keys))) == sorted(map(str, [("u", "a", 2), *want[1:], ("u", None, 5), (None, "a", 6)]))


def rows_of(spark, path, keys):
    return [tuple(r) for r in sinks.upserted(spark, path, keys).select(*keys, "total_count").collect()]


def test_sketches_stay_within_their_error(spark, tmp_path):
    """40,000 users in batches that overlap: by far more than a sketch lists."""
    path = str(tmp_path / "watchers")
    for batch in range(4):
        users = spark.range(batch * 10_000, batch * 10_000 + 20_000)
        sinks.append_sketches(
            users.selectExpr("cast(id as string) AS user_id", "concat('s', id % 2) AS show_id", f"'2024-01-0{1 + batch % 2}' AS day"),
            batch, path, date="day",
        )
        if batch == 2:
            sinks.merge_sketches(spark, path)
    bound = 4 * 1.04 / 2 ** (sketches.LG_K / 2)
    found = {r.show_id: r.watchers for r in sinks.read_watchers(spark, path).collect()}
    assert set(found) == {"s0", "s1"} and all(abs(n - 25_000) <= bound * 25_000 for n in found.values())
    one_day = {r.show_id: r.watchers for r in sinks.read_watchers(spark, path, ["2024-01-01"]).collect()}
    assert all(abs(n - 20_000) <= bound * 20_000 for n in one_day.values())
    assert sinks.read_watchers(spark, str(tmp_path / "none")).collect() == []


def test_few_users_are_counted_exactly(spark, tmp_path):
    rows = [(i, f"u{i % 700}" if i % 9 else None, "s", i * 40) for i in range(3_000)]
    events = table(spark, rows).withColumn("record_date", F.date_format("ts", "yyyy-MM-dd"))
    sinks.append_sketches(events, 0, str(tmp_path / "w"))
    (row,) = sinks.read_watchers(spark, str(tmp_path / "w")).collect()
    assert row.watchers == len({u for _, u, _, _ in rows if u})
    assert windows.pane_watchers(table(spark, rows)).where("user_id IS NULL").count() == 0
