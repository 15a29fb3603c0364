"""Named queries over the `events` table, each with the SQL that defines its result.

The table plays a stream of views: `event_type` is the show, `value` the rating, `event_id` the order of arrival.
"""

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from showpulse.functions import codec, keytext
from showpulse.operators import counts, dedup, totals, views, windows
from showpulse.plans.jobs import batch_job, streaming_job
from showpulse.sources.files import file_events
from showpulse.sources.shared import settled, shared_folder
from showpulse.streaming import native, sinks, stateful, tables

HOUR = "1 hour"
SMALL_BLOCK = 100  # rows: cuts the keys of small tables into blocks too
PIECES = 3
PAGES = 512  # of stream state: some ten keys of the tables at hand in each


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("event_type", "show_id")


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "user_id", "show_id", "ts")


def watch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_watch_events(events(spark, sf_dir))


def as_watch_events(table: DataFrame) -> DataFrame:
    """The table in the shape of decoded messages."""
    return table.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("user_id") % 2 == 0, "Female").otherwise("Male").alias("user_gender"),
        F.lit(None).cast("string").alias("user_age"),
        (F.col("event_id") % 2).cast("string").alias("season"),
        (F.col("event_id") % 12).cast("string").alias("episode"),
        "show_id",
        F.lit(None).cast("string").alias("show_name"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("rating"),
        (30 + F.col("event_id") % 30).cast("double").alias("episode_length"),
    )


def plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone, as the table has them."""
    zoned = [field.name for field in df.schema if field.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


# --- gate ---------------------------------------------------------------------------------------------------------


def idle_gate(spark, sf_dir):
    return dedup.idle_gate(sightings(spark, sf_dir))


def idle_gate_flagged(spark, sf_dir):
    return dedup.idle_gate(sightings(spark, sf_dir), flag=True)


def idle_gate_flagged_split(spark, sf_dir):
    return dedup.idle_gate(sightings(spark, sf_dir), flag=True, rows_per_block=SMALL_BLOCK)


def untimed_sightings(spark, sf_dir):
    """Every 17th event loses its time."""
    return sightings(spark, sf_dir).withColumn("ts", F.when(F.col("event_id") % 17 != 0, F.col("ts")))


def idle_gate_untimed(spark, sf_dir):
    return dedup.idle_gate(untimed_sightings(spark, sf_dir))


def idle_gate_flagged_untimed(spark, sf_dir):
    return dedup.idle_gate(untimed_sightings(spark, sf_dir), flag=True)


def running_total_idle_untimed(spark, sf_dir):
    return totals.running_total_idle(untimed_sightings(spark, sf_dir), rows_per_block=SMALL_BLOCK)


def session_first(spark, sf_dir):
    return dedup.session_first(sightings(spark, sf_dir))


def first_per_batch(spark, sf_dir):
    return dedup.first_per_batch(sightings(spark, sf_dir), batch=HOUR)


def first_per_batch_5s(spark, sf_dir):
    return dedup.first_per_batch(sightings(spark, sf_dir))


def gated_totals(spark, sf_dir):
    return counts.count_by(dedup.idle_gate(sightings(spark, sf_dir)))


# --- totals -------------------------------------------------------------------------------------------------------


def running_total(spark, sf_dir):
    return totals.running_total(sightings(spark, sf_dir))


def running_total_split(spark, sf_dir):
    return totals.running_total(sightings(spark, sf_dir), rows_per_block=SMALL_BLOCK)


def running_total_idle(spark, sf_dir):
    return totals.running_total_idle(sightings(spark, sf_dir))


def running_total_idle_split(spark, sf_dir):
    return totals.running_total_idle(sightings(spark, sf_dir), rows_per_block=SMALL_BLOCK)


def gated_running_total(spark, sf_dir):
    return totals.running_total_idle(settled(dedup.idle_gate(sightings(spark, sf_dir))))


def running_total_updates(spark, sf_dir):
    return totals.running_total_updates(sightings(spark, sf_dir), batch=HOUR)


def batch_totals_5s(spark, sf_dir):
    return totals.running_total_updates(sightings(spark, sf_dir))


def total_latest_by_user(spark, sf_dir):
    return totals.newest_totals(sightings(spark, sf_dir), by="user_id")


def total_latest_by_user_show(spark, sf_dir):
    return totals.newest_totals(sightings(spark, sf_dir))


def total_rows(spark, sf_dir):
    updates = totals.running_total_updates(sightings(spark, sf_dir), batch=HOUR)
    return views.traffic_rows(updates, F.col("batch_start"))


def keyless_sightings(spark, sf_dir):
    """Every 5th event loses its show, every 7th its user."""
    return sightings(spark, sf_dir).withColumns(
        {
            "show_id": F.when(F.col("event_id") % 5 != 0, F.col("show_id")),
            "user_id": F.when(F.col("event_id") % 7 != 0, F.col("user_id")),
        }
    )


def null_key_counts(spark, sf_dir):
    return counts.count_by(keyless_sightings(spark, sf_dir))


def null_key_totals(spark, sf_dir):
    events = keyless_sightings(spark, sf_dir)
    idle = totals.running_total_idle(events).select("event_id", F.col("total_count").alias("idle_count"))
    return totals.running_total(events).join(idle, "event_id")


# --- windows ------------------------------------------------------------------------------------------------------


def sliding_counts(spark, sf_dir):
    return windows.sliding_counts(sightings(spark, sf_dir))


def sliding_counts_shifted(spark, sf_dir):
    return windows.sliding_counts(sightings(spark, sf_dir), start="7 seconds")


def gated_sliding_counts(spark, sf_dir):
    return windows.sliding_counts(dedup.idle_gate(sightings(spark, sf_dir)))


def window_latest(spark, sf_dir):
    return windows.newest_windows(sightings(spark, sf_dir))


def window_rows(spark, sf_dir):
    rows = views.traffic_rows(window_latest(spark, sf_dir), F.col("window_end"))
    return rows.withColumn("row_key", keytext.window_key(F.col("user_id"), F.col("show_id")))


def watchers_per_window(spark, sf_dir):
    return windows.watchers_per_window(sightings(spark, sf_dir))


# --- stored views -------------------------------------------------------------------------------------------------


def flat_views(rows: DataFrame) -> DataFrame:
    return plain_times(
        rows.select(
            "row_key",
            F.col("watchedEpisode.Season").alias("season"),
            F.col("watchedEpisode.Episode").alias("episode"),
            F.col("watchedEpisode.ShowId").alias("show_id"),
            F.col("watchDetails.rating").alias("rating"),
            F.col("watchDetails.time").alias("time"),
            F.col("userDetails.userId").alias("user_id"),
            F.col("userDetails.userGender").alias("user_gender"),
            F.col("userDetails.watchTime").alias("watch_time"),
            "record_date",
        )
    )


def view_rows(spark, sf_dir):
    stored, _ = views.split_storable(watch_events(spark, sf_dir))
    return flat_views(views.view_rows(stored, F.col("event_time")))


def view_cells(spark, sf_dir):
    cells = views.view_cells(views.view_rows(watch_events(spark, sf_dir), F.col("event_time")))
    text = keytext.cell_text
    return cells.select(
        text(F.col("row_key")).alias("row_key"),
        text(F.col("watchedEpisode.ShowId")).alias("show_id"),
        text(F.col("watchDetails.rating")).alias("rating"),
        text(F.col("userDetails.userGender")).alias("user_gender"),
        text(F.col("userDetails.watchTime")).alias("watch_time"),
    )


def view_rows_last_per_second(spark, sf_dir):
    return views.last_per_second(sightings(spark, sf_dir))


def view_key_roundtrip(spark, sf_dir):
    cells = views.view_cells(views.view_rows(watch_events(spark, sf_dir), F.col("event_time")))
    return plain_times(views.cells_to_events(cells))


def view_split_storable(spark, sf_dir):
    """Every 11th event loses its show, every 13th its season."""
    damaged = watch_events(spark, sf_dir).withColumns(
        {
            "show_id": F.when(F.col("event_id") % 11 != 0, F.col("show_id")),
            "season": F.when(F.col("event_id") % 13 != 0, F.col("season")),
        }
    )
    stored, rejected = views.split_storable(damaged)
    kept = stored.select("event_id", F.lit("stored").alias("outcome"))
    return kept.unionByName(rejected.select("event_id", F.lit("rejected").alias("outcome")))


# --- counts over stored views -------------------------------------------------------------------------------------


def view_counts(spark, sf_dir):
    return counts.view_counts(sightings(spark, sf_dir))


def view_count_lines(spark, sf_dir):
    return counts.pair_lines(counts.view_counts(sightings(spark, sf_dir)), "count_key", "view_count")


def group_count(spark, sf_dir):
    return counts.group_count(sightings(spark, sf_dir))


def views_per_show(spark, sf_dir):
    return counts.views_per_show(sightings(spark, sf_dir))


def watchers_per_show(spark, sf_dir):
    return counts.watchers_per_show(sightings(spark, sf_dir))


# --- messages -----------------------------------------------------------------------------------------------------


def json_roundtrip(spark, sf_dir):
    good, _ = codec.decode_events(codec.encode_events(watch_events(spark, sf_dir)))
    return plain_times(good.drop("user_age", "show_name"))


def json_messages(spark, sf_dir):
    return codec.encode_events(watch_events(spark, sf_dir))


def decode_quarantine(spark, sf_dir):
    """Every 7th message is cut short before decoding."""
    source = watch_events(spark, sf_dir)
    whole = F.to_json(F.struct(F.col("user_id").alias("userId"), F.col("show_id").alias("showId")))
    cut = F.expr("left(message, length(message) - 3)")
    messages = source.withColumn("message", whole).select(
        F.when(F.col("event_id") % 7 == 0, cut).otherwise(F.col("message")).alias("value")
    )
    good, quarantined = codec.decode_events(messages)
    parts = good.select(F.lit("good").alias("outcome")).unionByName(quarantined.select(F.lit("bad").alias("outcome")))
    return parts.groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


# --- streams ------------------------------------------------------------------------------------------------------
#
# The whole table is streamed in parts by time, and every stream is stopped and started again after each part, so that keys,
# windows and visits cross triggers and restarts. Results are written to the shared folder and read back.


def parts_by_time(spark: SparkSession, sf_dir: str, backwards: bool = False) -> Iterator[DataFrame]:
    """The table in PIECES parts by time, events without a time in the first; `backwards` gives the newest part first."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    ends = table.agg(F.min("ts").alias("a"), F.max("ts").alias("z")).first()
    step = (ends.z - ends.a) / PIECES if ends.a else None
    for k in sorted(range(PIECES if step else 0), reverse=backwards):
        above, below = F.col("ts") >= ends.a + k * step, F.col("ts") < ends.a + (k + 1) * step
        part = table.where((above if k else F.lit(True)) & (below if k < PIECES - 1 else F.lit(True)))
        yield part if k else part.unionByName(table.where("ts IS NULL"))


def live_events(spark: SparkSession, sf_dir: str, folder: str, backwards: bool = False) -> Iterator[DataFrame]:
    """The stream of the table's events, once for each part, after that part has arrived."""
    for part in parts_by_time(spark, sf_dir, backwards):
        part.write.mode("append").parquet(f"{folder}/sent")
        stream = file_events(spark, f"{folder}/sent", part.schema, max_files=None)
        yield stream.withColumnRenamed("event_type", "show_id")


def sightings_of(events: DataFrame) -> DataFrame:
    return events.select("event_id", "user_id", "show_id", F.col("ts").cast("timestamp").alias("ts"))


def drained(spark: SparkSession, sf_dir: str, folder: str, of: Callable[[DataFrame], DataFrame], mode: str, writer) -> None:
    """Run what `of` makes of the stream to the end of the input."""
    for events in live_events(spark, sf_dir, folder):
        stream = of(events).writeStream.outputMode(mode).trigger(availableNow=True)
        stream.option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(writer).start().awaitTermination()


def upserts_of(spark: SparkSession, sf_dir: str, of: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """Run a stream in update mode into an upsert table, and read the table."""
    folder = shared_folder(spark)
    drained(spark, sf_dir, folder, of, "update", lambda batch, batch_id: sinks.upsert_log(batch, batch_id, f"{folder}/table"))
    return plain_times(sinks.upserted(spark, f"{folder}/table", keys).drop("batch_id"))


def stored_of(spark: SparkSession, sf_dir: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stream in append mode into a table of batches, and read the table."""
    folder = shared_folder(spark)
    drained(spark, sf_dir, folder, of, "append", lambda batch, batch_id: tables.write_batch(batch, batch_id, f"{folder}/table"))
    return spark.read.parquet(f"{folder}/table").drop("batch_id")


def stream_idle_gate(spark, sf_dir):
    return plain_times(stored_of(spark, sf_dir, lambda events: stateful.idle_gate_stream(sightings_of(events), pages=PAGES)))


def stream_running_total_idle(spark, sf_dir):
    keys = ["user_id", "show_id", "visit_start"]
    return upserts_of(spark, sf_dir, lambda events: stateful.running_total_idle_stream(sightings_of(events), pages=PAGES), keys)


def stream_day_streaks(spark, sf_dir):
    return upserts_of(spark, sf_dir, lambda events: stateful.day_streaks_stream(sightings_of(events), pages=PAGES), ["user_id"])


def stream_total(spark, sf_dir):
    keys = ["user_id", "show_id"]
    return upserts_of(spark, sf_dir, lambda events: native.running_total_stream(sightings_of(events)), keys)


def stream_total_updates(spark, sf_dir):
    """What each part of the stream emits: one row for each key that occurs in it, and none for others."""
    folder = shared_folder(spark)

    def store(batch: DataFrame, batch_id: int) -> None:
        sinks.upsert_log(batch, batch_id, f"{folder}/table")

    drained(spark, sf_dir, folder, lambda events: native.running_total_stream(sightings_of(events)), "update", store)
    log = spark.read.parquet(f"{folder}/table/log")
    # Triggers without events have batch numbers too, so parts are numbered in the order of the batches that have rows.
    numbered = log.select("batch_id").distinct().withColumn(
        "part", F.row_number().over(Window.orderBy("batch_id")).cast("long") - 1
    )  # PIECES rows
    return log.join(F.broadcast(numbered), "batch_id").drop("batch_id")


def stream_sliding_counts(spark, sf_dir):
    def panes(events: DataFrame) -> DataFrame:
        return windows.pane_counts(sightings_of(events).withWatermark("ts", "0 seconds"))

    return windows.sliding_from_panes(upserts_of(spark, sf_dir, panes, sinks.PANE))


def stream_watchers_per_window(spark, sf_dir):
    def first_sightings(events: DataFrame) -> DataFrame:
        return windows.pane_watchers(sightings_of(events), lateness="0 seconds")

    return plain_times(windows.watchers_from_panes(stored_of(spark, sf_dir, first_sightings)))


def stream_watchers_sketched(spark, sf_dir):
    """Watchers per show from stored sketches of each show and date; the raw events are not read again."""
    folder = shared_folder(spark)

    def store(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("record_date", keytext.record_date(F.col("ts")))
        sinks.append_sketches(dated, batch_id, f"{folder}/watchers")
        if batch_id == 1:
            sinks.merge_sketches(spark, f"{folder}/watchers")

    drained(spark, sf_dir, folder, sightings_of, "append", store)
    return sinks.read_watchers(spark, f"{folder}/watchers")


def stream_first_per_batch(spark, sf_dir):
    def first(events: DataFrame) -> DataFrame:
        rows = dedup.first_per_batch(sightings_of(events).withWatermark("ts", "0 seconds"), batch=HOUR)
        return rows.withColumn("hour", F.date_trunc("hour", "ts"))

    return upserts_of(spark, sf_dir, first, ["user_id", "hour"]).drop("hour")


def stream_view_store(spark, sf_dir):
    folder = shared_folder(spark)

    def store(batch: DataFrame, batch_id: int) -> None:
        sinks.append_views(batch, batch_id, f"{folder}/view", written_at=F.col("event_time"))

    drained(spark, sf_dir, folder, as_watch_events, "append", store)
    return flat_views(sinks.stored_views(spark, f"{folder}/view"))


def stream_view_store_merged(spark, sf_dir):
    """As `stream_view_store`, with the batches merged by date twice on the way, and some batches after that."""
    folder = shared_folder(spark)

    def store(batch: DataFrame, batch_id: int) -> None:
        sinks.append_views(batch, batch_id, f"{folder}/view", written_at=F.col("event_time"))
        if batch_id < 2:
            sinks.merge_views(spark, f"{folder}/view")

    drained(spark, sf_dir, folder, as_watch_events, "append", store)
    return flat_views(sinks.stored_views(spark, f"{folder}/view"))


def view_stamps(spark, sf_dir):
    """How many views are stored, and how many with a time of writing that lies within the run."""
    folder = shared_folder(spark)
    begun = spark.range(1).select(F.current_timestamp()).first()[0]

    def store(batch: DataFrame, batch_id: int) -> None:
        sinks.append_views(batch, batch_id, f"{folder}/view")

    drained(spark, sf_dir, folder, as_watch_events, "append", store)
    within = F.col("written_at").between(F.lit(begun), F.current_timestamp())
    named = F.col("row_key") == keytext.view_key(F.col("userDetails.userId"), F.col("written_at"))
    return sinks.stored_views(spark, f"{folder}/view").agg(F.count(F.lit(1)).alias("views"), F.count_if(within & named).alias("stamped"))


def job_tables(spark, sf_dir, backwards: bool = False, **options) -> str:
    """Run the streaming job over the table's messages, anew after each part of them; the folder of its tables."""
    folder = shared_folder(spark)
    for events in live_events(spark, sf_dir, folder, backwards):
        messages = codec.encode_events(as_watch_events(events), keep=["event_id"])
        settings = {"order": "event_id", "pages": PAGES} | options
        streaming_job(spark, messages, folder, f"{folder}/checkpoint", {"availableNow": True}, **settings)
    return folder


def job_totals(spark, sf_dir):
    folder = job_tables(spark, sf_dir, clock="event", lateness="0 seconds", merge_every=2)
    rows = sinks.read_totals(spark, f"{folder}/total_traffic", ["user_id"])
    return plain_times(rows.select("user_id", "show_id", "visit_start", "total_count"))


def job_windows(spark, sf_dir):
    keys = ["user_id", "show_id"]
    folder = job_tables(spark, sf_dir, clock="event", lateness="0 seconds", merge_every=2)
    rows = sinks.read_windows(spark, f"{folder}/window_traffic", keys)
    return plain_times(rows.select(*keys, "window_end", "total_count"))


def job_late_events(spark, sf_dir):
    """Newest events first, by arrival: how often each user and show is stored, and counted over all visits."""
    folder = job_tables(spark, sf_dir, backwards=True, gated=False)
    stored = counts.count_by(views.views_to_events(sinks.stored_views(spark, f"{folder}/view")), name="stored")
    visits = sinks.upserted(spark, f"{folder}/total_traffic", ["user_id", "show_id", "visit_start"], "visit_end")
    counted = visits.groupBy("user_id", "show_id").agg(F.sum("total_count").alias("counted"))
    return stored.join(counted, ["user_id", "show_id"], "full")


def job_batch_counts(spark, sf_dir):
    """Store the views, then count them with the batch job; the text lines it writes."""
    folder = shared_folder(spark)
    rows = views.view_rows(watch_events(spark, sf_dir), F.col("event_time"))
    tables.append_batch(rows, 0, f"{folder}/view", [sinks.DATE])
    batch_job(spark, f"{folder}/view", folder)
    return spark.read.text(f"{folder}/batchResult.txt")


# --- SQL ----------------------------------------------------------------------------------------------------------

_SIGHTINGS = "s AS (SELECT event_id, user_id, event_type AS show_id, ts FROM events)"

_GATE_OF_S = """lagged AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM s),
gate AS (SELECT event_id, user_id, show_id, ts FROM lagged WHERE p IS NULL OR ts - p > INTERVAL 3600 SECONDS)"""

_GATE = f"{_SIGHTINGS}, {_GATE_OF_S}"


def _idle_total(source: str) -> str:
    return f"""stepped AS (SELECT event_id, user_id, show_id, ts,
    lag(ts) OVER (PARTITION BY user_id, show_id ORDER BY ts, event_id) AS p FROM {source}),
visits AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p > INTERVAL 3600 SECONDS THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id, show_id ORDER BY ts, event_id) AS v FROM stepped),
idle AS (SELECT event_id, user_id, show_id, ts, v,
    row_number() OVER (PARTITION BY user_id, show_id, v ORDER BY ts, event_id) AS total_count FROM visits)"""


_RUNNING = f"""{_SIGHTINGS},
running AS (SELECT *, count(*) OVER (PARTITION BY user_id, show_id ORDER BY ts, event_id
    ROWS UNBOUNDED PRECEDING) AS total_count FROM s)"""


def _first_per_batch(seconds: int) -> str:
    return f"""WITH {_SIGHTINGS}, ranked AS (SELECT *, row_number() OVER (
    PARTITION BY user_id, floor(epoch_us(ts) / {seconds * 1_000_000}) ORDER BY ts, event_id) AS n FROM s)
SELECT event_id, user_id, show_id, ts FROM ranked WHERE n = 1"""


def _updates(seconds: int) -> str:
    return f"""{_SIGHTINGS},
batches AS (SELECT user_id, show_id, time_bucket(INTERVAL {seconds} SECONDS, ts, TIMESTAMP '1970-01-01') AS batch_start,
    count(*) AS batch_count FROM s GROUP BY ALL),
updates AS (SELECT *, CAST(sum(batch_count) OVER (PARTITION BY user_id, show_id ORDER BY batch_start
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_count FROM batches)"""


def _windows(source: str, shift: int = 0) -> str:
    return f"""expanded AS (SELECT *, unnest(range(
        CAST(floor((epoch_us(ts) - {shift * 1_000_000}) / 30000000) AS BIGINT) - 4,
        CAST(floor((epoch_us(ts) - {shift * 1_000_000}) / 30000000) AS BIGINT) + 1)) AS b FROM {source}),
windowed AS (SELECT *, make_timestamp((b * 30 + {shift}) * 1000000) AS window_start,
    make_timestamp((b * 30 + {shift} + 150) * 1000000) AS window_end FROM expanded),
sliding AS (SELECT user_id, show_id, window_start, window_end, count(*) AS total_count FROM windowed GROUP BY ALL)"""


_WATCH = """w AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
    CASE WHEN user_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS user_gender,
    CAST(event_id % 2 AS VARCHAR) AS season, CAST(event_id % 12 AS VARCHAR) AS episode, event_type AS show_id,
    ts AS event_time, value AS rating, CAST(30 + event_id % 30 AS DOUBLE) AS episode_length FROM events)"""

_KEY_TEXT = "concat(user_id, ';', strftime(event_time, '%a %b %d %H:%M:%S UTC %Y'))"

_WINDOW_LATEST = f"""{_SIGHTINGS}, {_windows("s")},
newest AS (SELECT *, row_number() OVER (PARTITION BY user_id, show_id ORDER BY window_end DESC) AS n FROM sliding)"""

_GATE_SQL = f"WITH {_GATE} SELECT * FROM gate"
_FLAGGED_SQL = f"""WITH {_GATE} SELECT event_id, user_id, show_id, ts,
    NOT (p IS NULL OR ts - p > INTERVAL 3600 SECONDS) AS seen FROM lagged"""
_UNTIMED = """whole AS (SELECT event_id, user_id, event_type AS show_id,
    CASE WHEN event_id % 17 <> 0 THEN ts END AS ts FROM events), s AS (SELECT * FROM whole WHERE ts IS NOT NULL)"""
_VISITS_SQL = f"""WITH {_GATE}, numbered AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p > INTERVAL 3600 SECONDS
    THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS v FROM lagged)
SELECT min_by(event_id, (ts, event_id)) AS event_id, user_id, min_by(show_id, (ts, event_id)) AS show_id,
    min(ts) AS ts, max(ts) AS visit_end, count(*) AS visit_events FROM numbered GROUP BY user_id, v"""
_VIEW_ROWS_SQL = f"""WITH {_WATCH} SELECT {_KEY_TEXT} AS row_key, season, episode, show_id, rating, episode_length AS time,
    user_id, user_gender, event_time AS watch_time, strftime(event_time, '%Y-%m-%d') AS record_date FROM w"""
_FIRST_PER_HOUR_SQL = _first_per_batch(3600)
_COUNT_LINES_SQL = (
    "SELECT concat('(', user_id, event_type, ',', count(*), ')') AS value FROM events GROUP BY user_id, event_type"
)
# The job sees times to the second, users as text, and only the views that pass the gate.
_JOB_GATE = f"""{_WATCH}, s AS (SELECT event_id, user_id, show_id, date_trunc('second', event_time) AS ts FROM w),
{_GATE_OF_S}"""
_VISIT_TOTALS = """visit_totals AS (SELECT user_id, show_id, min(ts) AS visit_start, max(ts) AS visit_end,
    count(*) AS total_count FROM idle GROUP BY user_id, show_id, v)"""
_WATCHERS_PER_SHOW_SQL = "SELECT event_type AS show_id, count(DISTINCT user_id) AS watchers FROM events GROUP BY event_type"
_SLIDING_SQL = f"WITH {_SIGHTINGS}, {_windows('s')} SELECT * FROM sliding"
_WATCHERS_SQL = f"""WITH {_SIGHTINGS}, {_windows("s")} SELECT show_id, window_start, window_end,
    count(DISTINCT user_id) AS watchers FROM windowed GROUP BY ALL"""
# Runs of days: a day less its place among the user's days is the same for all days of a run.
_STREAKS_SQL = """WITH days AS (SELECT DISTINCT user_id, CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS d FROM events),
runs AS (SELECT user_id, max(d) AS newest, count(*) AS n FROM
    (SELECT user_id, d, d - row_number() OVER (PARTITION BY user_id ORDER BY d) AS run FROM days) GROUP BY user_id, run)
SELECT user_id, max_by(n, newest) AS days, max(n) AS longest_days FROM runs GROUP BY user_id"""
_KEYLESS = """k AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
    CASE WHEN event_id % 5 <> 0 THEN event_type END AS show_id, ts FROM events),
s AS (SELECT * FROM k WHERE user_id IS NOT NULL AND show_id IS NOT NULL),
alone AS (SELECT * FROM k WHERE user_id IS NULL OR show_id IS NULL)"""
# Parts as `parts_by_time` cuts them.
_PARTS = f"""bounds AS (SELECT min(epoch_us(ts)) AS a, CAST(round((max(epoch_us(ts)) - min(epoch_us(ts))) / {PIECES}.0) AS BIGINT) AS step
    FROM events), parts AS (SELECT user_id, event_type AS show_id, ts,
    least((epoch_us(ts) - a) // step, {PIECES - 1}) AS part FROM events, bounds)"""

# Each query with its SQL.
QUERIES = {
    "idle_gate": (idle_gate, _GATE_SQL),
    "idle_gate_flagged": (
        idle_gate_flagged,
        _FLAGGED_SQL,
    ),
    "idle_gate_flagged_split": (idle_gate_flagged_split, _FLAGGED_SQL),
    "idle_gate_untimed": (idle_gate_untimed, f"WITH {_UNTIMED}, {_GATE_OF_S} SELECT * FROM gate"),
    "idle_gate_flagged_untimed": (
        idle_gate_flagged_untimed,
        f"""WITH {_UNTIMED}, {_GATE_OF_S} SELECT event_id, user_id, show_id, ts,
    NOT (p IS NULL OR ts - p > INTERVAL 3600 SECONDS) AS seen FROM lagged
UNION ALL SELECT event_id, user_id, show_id, ts, NULL FROM whole WHERE ts IS NULL""",
    ),
    "running_total_idle_untimed": (
        running_total_idle_untimed,
        f"""WITH {_UNTIMED}, {_idle_total("s")} SELECT event_id, user_id, show_id, ts, total_count FROM idle
UNION ALL SELECT event_id, user_id, show_id, ts, NULL FROM whole WHERE ts IS NULL""",
    ),
    "session_first": (session_first, _VISITS_SQL),
    "gated_totals": (
        gated_totals,
        f"WITH {_GATE} SELECT user_id, show_id, count(*) AS total_count FROM gate GROUP BY ALL",
    ),
    "running_total_idle": (
        running_total_idle,
        f"WITH {_SIGHTINGS}, {_idle_total('s')} SELECT event_id, user_id, show_id, ts, total_count FROM idle",
    ),
    "gated_running_total": (
        gated_running_total,
        f"WITH {_GATE}, {_idle_total('gate')} SELECT event_id, user_id, show_id, ts, total_count FROM idle",
    ),
    "running_total": (running_total, f"WITH {_RUNNING} SELECT * FROM running"),
    "running_total_split": (running_total_split, f"WITH {_RUNNING} SELECT * FROM running"),
    "running_total_idle_split": (
        running_total_idle_split,
        f"WITH {_SIGHTINGS}, {_idle_total('s')} SELECT event_id, user_id, show_id, ts, total_count FROM idle",
    ),
    "null_key_counts": (
        null_key_counts,
        f"""WITH {_KEYLESS} SELECT user_id, show_id, count(*) AS total_count FROM s GROUP BY ALL
UNION ALL SELECT user_id, show_id, 1 FROM alone""",
    ),
    "null_key_totals": (
        null_key_totals,
        f"""WITH {_KEYLESS}, {_idle_total("s")}
SELECT event_id, user_id, show_id, ts, total_count AS idle_count, count(*) OVER (PARTITION BY user_id, show_id
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS total_count FROM idle
UNION ALL SELECT event_id, user_id, show_id, ts, 1, 1 FROM alone""",
    ),
    "running_total_updates": (running_total_updates, f"WITH {_updates(3600)} SELECT * FROM updates"),
    "batch_totals_5s": (batch_totals_5s, f"WITH {_updates(5)} SELECT * FROM updates"),
    "first_per_batch": (first_per_batch, _FIRST_PER_HOUR_SQL),
    "first_per_batch_5s": (first_per_batch_5s, _first_per_batch(5)),
    "sliding_counts": (sliding_counts, _SLIDING_SQL),
    "sliding_counts_shifted": (
        sliding_counts_shifted,
        f"WITH {_SIGHTINGS}, {_windows('s', 7)} SELECT * FROM sliding",
    ),
    "gated_sliding_counts": (gated_sliding_counts, f"WITH {_GATE}, {_windows('gate')} SELECT * FROM sliding"),
    "window_latest": (
        window_latest,
        f"WITH {_WINDOW_LATEST} SELECT user_id, show_id, window_start, window_end, total_count FROM newest WHERE n = 1",
    ),
    "window_rows": (
        window_rows,
        f"""WITH {_WINDOW_LATEST} SELECT user_id, show_id, total_count, window_end AS time_stamp,
    strftime(window_end, '%Y-%m-%d') AS record_date, concat(user_id, '=>', show_id) AS row_key FROM newest WHERE n = 1""",
    ),
    "watchers_per_window": (watchers_per_window, _WATCHERS_SQL),
    "total_latest_by_user": (
        total_latest_by_user,
        f"""WITH {_RUNNING}, newest AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
    AS n FROM running) SELECT event_id, user_id, show_id, ts, total_count FROM newest WHERE n = 1""",
    ),
    "total_latest_by_user_show": (
        total_latest_by_user_show,
        f"""WITH {_RUNNING}, newest AS (SELECT *, row_number() OVER (PARTITION BY user_id, show_id
    ORDER BY ts DESC, event_id DESC) AS n FROM running)
SELECT event_id, user_id, show_id, ts, total_count FROM newest WHERE n = 1""",
    ),
    "total_rows": (
        total_rows,
        f"""WITH {_updates(3600)} SELECT user_id, show_id, total_count, batch_start AS time_stamp,
    strftime(batch_start, '%Y-%m-%d') AS record_date FROM updates""",
    ),
    "view_rows": (
        view_rows,
        _VIEW_ROWS_SQL,
    ),
    "view_cells": (
        view_cells,
        f"""WITH {_WATCH} SELECT {_KEY_TEXT} AS row_key, show_id, CAST(rating AS VARCHAR) AS rating, user_gender,
    strftime(event_time, '%a %b %d %H:%M:%S UTC %Y') AS watch_time FROM w""",
    ),
    "view_rows_last_per_second": (
        view_rows_last_per_second,
        f"""WITH {_SIGHTINGS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('second', ts)
    ORDER BY ts DESC, event_id DESC) AS n FROM s) SELECT event_id, user_id, show_id, ts FROM ranked WHERE n = 1""",
    ),
    "view_key_roundtrip": (
        view_key_roundtrip,
        f"""WITH {_WATCH} SELECT user_id, user_gender, show_id, episode, season, date_trunc('second', event_time) AS event_time,
    rating, episode_length, date_trunc('second', event_time) AS written_at FROM w""",
    ),
    "view_split_storable": (
        view_split_storable,
        """SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'rejected' ELSE 'stored' END AS outcome
FROM events""",
    ),
    "view_counts": (
        view_counts,
        """SELECT concat(user_id, event_type) AS count_key, user_id, event_type AS show_id, count(*) AS view_count
FROM events GROUP BY user_id, event_type""",
    ),
    "view_count_lines": (
        view_count_lines,
        _COUNT_LINES_SQL,
    ),
    "group_count": (
        group_count,
        "SELECT count(*) AS groups FROM (SELECT DISTINCT user_id, event_type FROM events)",
    ),
    "views_per_show": (
        views_per_show,
        "SELECT event_type AS show_id, count(*) AS views FROM events GROUP BY event_type",
    ),
    "watchers_per_show": (watchers_per_show, _WATCHERS_PER_SHOW_SQL),
    "json_roundtrip": (
        json_roundtrip,
        f"""WITH {_WATCH} SELECT user_id, user_gender, season, episode, show_id,
    date_trunc('second', event_time) AS event_time, rating, episode_length FROM w""",
    ),
    "json_messages": (
        json_messages,
        f"""WITH {_WATCH} SELECT concat('{{"userId":"', user_id, '","userGender":"', user_gender, '","season":"', season,
    '","episode":"', episode, '","showId":"', show_id, '","timestamp":"',
    strftime(event_time - INTERVAL 7 HOURS, '%Y-%m-%d %H:%M:%S'), '","rating":', CAST(rating AS VARCHAR),
    ',"episodeLength":', CAST(episode_length AS VARCHAR), '}}') AS value FROM w""",
    ),
    "decode_quarantine": (
        decode_quarantine,
        """SELECT CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE 'good' END AS outcome, count(*) AS messages
FROM events GROUP BY ALL""",
    ),
    "stream_idle_gate": (stream_idle_gate, _GATE_SQL),
    "stream_running_total_idle": (
        stream_running_total_idle,
        f"WITH {_SIGHTINGS}, {_idle_total('s')}, {_VISIT_TOTALS} SELECT * FROM visit_totals",
    ),
    "stream_total": (
        stream_total,
        "SELECT user_id, event_type AS show_id, count(*) AS total_count FROM events GROUP BY ALL",
    ),
    "stream_day_streaks": (stream_day_streaks, _STREAKS_SQL),
    "stream_total_updates": (
        stream_total_updates,
        f"""WITH {_PARTS}, counted AS (SELECT part, user_id, show_id, count(*) AS n FROM parts GROUP BY ALL)
SELECT part, user_id, show_id, CAST(sum(n) OVER (PARTITION BY user_id, show_id ORDER BY part) AS BIGINT) AS total_count
FROM counted""",
    ),
    "stream_sliding_counts": (stream_sliding_counts, _SLIDING_SQL),
    "stream_watchers_per_window": (stream_watchers_per_window, _WATCHERS_SQL),
    # Sketches list up to 1,536 users of a show before they estimate.
    "stream_watchers_sketched": (stream_watchers_sketched, _WATCHERS_PER_SHOW_SQL),
    "stream_first_per_batch": (stream_first_per_batch, _FIRST_PER_HOUR_SQL),
    "stream_view_store": (stream_view_store, _VIEW_ROWS_SQL),
    "stream_view_store_merged": (stream_view_store_merged, _VIEW_ROWS_SQL),
    "view_stamps": (view_stamps, "SELECT count(*) AS views, count(*) AS stamped FROM events"),
    "job_totals": (
        job_totals,
        f"""WITH {_JOB_GATE}, {_idle_total("gate")}, {_VISIT_TOTALS}, newest AS (SELECT *, row_number() OVER (
    PARTITION BY user_id ORDER BY visit_start DESC, show_id DESC) AS n FROM visit_totals)
SELECT user_id, show_id, visit_start, total_count FROM newest WHERE n = 1""",
    ),
    "job_windows": (
        job_windows,
        f"""WITH {_JOB_GATE}, {_windows("gate")}, newest AS (SELECT *, row_number() OVER (
    PARTITION BY user_id, show_id ORDER BY window_end DESC) AS n FROM sliding)
SELECT user_id, show_id, window_end, total_count FROM newest WHERE n = 1""",
    ),
    "job_late_events": (
        job_late_events,
        """SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS show_id, count(*) AS stored,
    CAST(count(*) AS BIGINT) AS counted FROM events GROUP BY ALL""",
    ),
    "job_batch_counts": (job_batch_counts, _COUNT_LINES_SQL),
}
