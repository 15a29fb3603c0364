"""The two jobs: live traffic from messages, and counts over stored views."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from showpulse.functions.codec import parse_events
from showpulse.operators.counts import group_count, view_counts
from showpulse.operators.views import REQUIRED, split_storable, traffic_rows, views_to_events
from showpulse.operators.windows import pane_counts
from showpulse.sources.files import file_system
from showpulse.streaming import sinks
from showpulse.streaming.keyed import PAGES
from showpulse.streaming.stateful import idle_gate_stream, running_total_idle_stream
from showpulse.streaming.tables import write_batch

KEYS = ["user_id", "show_id"]
VISIT = [*KEYS, "visit_start"]
ARRIVED = "counted_at"
# Fixed value: name of the text file of counts.
COUNTS_TEXT = "batchResult.txt"
EVERY_5_SECONDS = {"processingTime": "5 seconds"}
MERGE_EVERY = 100
"""Batches of a table that are merged at once."""


def streaming_job(
    spark: SparkSession,
    messages: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    ts: str = "event_time",
    order: str | list[str] = ("source_partition", "source_offset"),
    gap: str = "3600 seconds",
    clock: str = "arrival",
    lateness: str | None = None,
    gated: bool = True,
    allow_late: bool = False,
    merge_every: int = MERGE_EVERY,
    pages: int = PAGES,
) -> list[StreamingQuery]:
    """Store views and bad messages, gate users, keep totals and window counts. `messages` is a stream with `value`.

    Each message is parsed once, into the table `decoded`, whose log of finished batches all other queries follow, each from
    its own checkpoint: any of them may stop or fail and go on later. Tables under `out`: `decoded`, `gated`, `quarantine`,
    `rejected` (parquet); `view`, `watchers` (by date), `total_traffic`, `window_traffic` (upserts, the latter of panes; see
    `sinks.read_…`). A table's batches are merged into its parts whenever there are `merge_every` new ones. `pages` of state: see
    `streaming.keyed`.

    With `gated`, a user counts once per idle gap, in the totals and windows too; without, every view does.
    `clock="arrival"`, the default, counts an event when it arrives: idle gaps, visits and windows go by the start time of
    the micro-batch that first held it (`counted_at`), so no event is late and none is lost, in whatever order they
    come and with or without a time of their own. These times never go back, whatever the clock of the machine that a job is
    started on says. `clock="event"` goes by the time in the events and needs `lateness`, how far back times may lie; events
    without a time are then `rejected`. Spark drops events beyond it; a job that ends counts them and fails if there are any,
    unless `allow_late`. For a job that keeps running, add a `LateRows` listener to the session.

    A trigger that ends by itself (`{"availableNow": True}`) ends every query, in the order they depend on each other.
    """
    trigger = trigger or EVERY_5_SECONDS
    ends = trigger.get("availableNow") or trigger.get("once")
    if clock not in ("arrival", "event"):
        raise ValueError(f"unknown clock: {clock}")
    if clock == "event" and lateness is None:
        raise ValueError("with the event clock, say by how much events may be late")
    arrival = clock == "arrival"
    required = REQUIRED if arrival else (*REQUIRED, ts)
    # By arrival, batches whose stamps are equal must not be late.
    when, lateness = (ARRIVED, "1 second") if arrival else (ts, lateness)
    late = LateRows()
    if ends:
        spark.streams.addListener(late)

    def start(df: DataFrame, name: str, writer) -> StreamingQuery:
        stream = df.writeStream.outputMode("update").trigger(**trigger)
        return stream.option("checkpointLocation", f"{checkpoint}/{name}").foreachBatch(writer).start()

    def stored(df: DataFrame, name: str) -> StreamingQuery:
        stream = df.writeStream.format("parquet").outputMode("append").trigger(**trigger)
        query = stream.option("checkpointLocation", f"{checkpoint}/{name}").start(f"{out}/{name}")
        if ends:
            query.awaitTermination()
        return query

    def often(merge):
        """A batch function that merges a table after every `merge_every` batches."""
        return lambda _, batch_id: merge() if (batch_id + 1) % merge_every == 0 else None

    def store(decoded: DataFrame, batch_id: int) -> None:
        good = decoded.where(~F.col("bad")).drop("bad", "value")
        sinks.append_views(
            good.drop(ARRIVED), batch_id, f"{out}/view", ts=ts, order=order, rejected=f"{out}/rejected", required=required
        )

    def sketch(decoded: DataFrame, batch_id: int) -> None:
        good, _ = split_storable(decoded.where(~F.col("bad")), required)
        dated = good.withColumn(sinks.DATE, F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
        sinks.append_sketches(dated, batch_id, f"{out}/watchers")

    def quarantine(decoded: DataFrame, batch_id: int) -> None:
        write_batch(decoded.where("bad").select(*messages.columns), batch_id, f"{out}/quarantine")

    queries = []
    try:
        parsed = parse_events(messages).withColumn("value", F.when(F.col("bad"), F.col("value")))
        if arrival:
            floor = F.timestamp_millis(F.lit(latest_stamp(spark, f"{checkpoint}/decoded")))
            parsed = parsed.withColumn(ARRIVED, F.greatest(F.current_timestamp(), floor))
        queries.append(stored(parsed, "decoded"))
        decoded = spark.readStream.schema(parsed.schema).parquet(f"{out}/decoded")

        merges = [
            often(lambda: sinks.merge_views(spark, f"{out}/view")),
            often(lambda: sinks.merge_sketches(spark, f"{out}/watchers")),
        ]
        queries.append(start(decoded, "view", sinks.shared(store, sketch, quarantine, *merges)))

        events, _ = split_storable(decoded.where(~F.col("bad")).drop("bad", "value"), required)
        counted = events
        if gated:
            queries.append(stored(idle_gate_stream(events, "user_id", when, order, gap, "event", lateness, pages), "gated"))
            counted = spark.readStream.schema(events.schema).parquet(f"{out}/gated")

        def upsert(df: DataFrame, name: str, keys: list[str], times: list[str]) -> StreamingQuery:
            def write(batch: DataFrame, batch_id: int) -> None:
                sinks.upsert_log(traffic_rows(batch, keys=(*KEYS, *times)), batch_id, f"{out}/{name}")
                merge(batch, batch_id)

            merge = often(lambda: sinks.merge_upserts(spark, f"{out}/{name}", keys))
            return start(df, name, write)

        totals = running_total_idle_stream(counted, KEYS, when, gap, "event", lateness, pages)
        panes = pane_counts(counted.withWatermark(when, lateness), KEYS, when)
        queries.append(upsert(totals, "total_traffic", VISIT, ["visit_start", "visit_end"]))
        queries.append(upsert(panes, "window_traffic", sinks.PANE, ["window_start"]))
        if ends:
            for query in queries:
                query.awaitTermination()
            if (dropped := late.total(queries)) and not allow_late:
                raise RuntimeError(f"{dropped} events or panes were later than {lateness} and are not counted")
    finally:
        if ends:
            spark.streams.removeListener(late)
    return queries


class LateRows(StreamingQueryListener):
    """Counts the rows that streams drop as they are behind the watermark, over all their batches."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run, states = str(event.progress.runId), event.progress.stateOperators
        self.dropped[run] = self.dropped.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in states)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def total(self, queries: list[StreamingQuery], patience: float = 60) -> int:
        """Rows that queries which have ended dropped. Events of a query are told in order, its end last."""
        runs, deadline = {str(query.runId) for query in queries}, time.monotonic() + patience
        while not runs <= self.ended:
            if time.monotonic() > deadline:
                raise RuntimeError("the ends of the queries have not been told")
            time.sleep(0.02)
        return sum(self.dropped.get(run, 0) for run in runs)


def latest_stamp(spark: SparkSession, checkpoint: str) -> int:
    """Milliseconds since 1970 below which a restarted query must not stamp its rows.

    It is the greatest batch time that the query's checkpoint knows of, or an earlier start has noted beside it, and is noted
    again. Spark keeps the times of the last batches only, which is why starts note them.
    """
    note = f"{checkpoint}-stamps"
    fs, path = file_system(spark, checkpoint), spark._jvm.org.apache.hadoop.fs.Path
    found = [0]
    offsets = fs.globStatus(path(f"{checkpoint}/offsets/*")) or []
    if offsets:
        # The second line of an offset file is a JSON object with the batch's time.
        lines = spark.read.text([status.getPath().toString() for status in offsets])
        times = lines.select(F.get_json_object("value", "$.batchTimestampMs").cast("long").alias("at"))
        found.append(times.agg(F.max("at")).first()[0] or 0)
    notes = fs.globStatus(path(f"{note}/*")) or []
    found += [int(status.getPath().getName()) for status in notes]
    stamp = max(found)
    if stamp and not fs.exists(path(f"{note}/{stamp}")):
        fs.mkdirs(path(note))
        fs.create(path(f"{note}/{stamp}"), True).close()
    return stamp


def batch_job(spark: SparkSession, views: str, out: str) -> DataFrame:
    """Count stored views per user and show, into `out/batch` and `out/batchResult.txt`; gives the number of groups."""
    sinks.write_counts(view_counts(views_to_events(sinks.stored_views(spark, views))), f"{out}/batch")
    counted = spark.read.parquet(f"{out}/batch")
    sinks.write_pairs_text(counted, "count_key", "view_count", f"{out}/{COUNTS_TEXT}")
    return group_count(counted, KEYS)
