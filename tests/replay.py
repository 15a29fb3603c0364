"""Small event tables, and streams that deliver them file by file."""

import os
import time
from datetime import datetime, timedelta, timezone

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, user_id string, show_id string, ts timestamp"


def at(seconds):
    return START + timedelta(seconds=seconds)


def seconds(time):
    return (time.replace(tzinfo=None) - START).total_seconds()


def table(spark, rows):
    """Rows are (event_id, user, show, seconds)."""
    data = [(i, u, s, None if t is None else at(t).replace(tzinfo=timezone.utc)) for i, u, s, t in rows]
    return spark.createDataFrame(data, SCHEMA)


class Replay:
    """A folder that a stream reads one file per trigger."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0

    def add(self, rows):
        # One file per call; the stream takes files by age, so each must be visibly younger than the last.
        self.files += 1
        target = self.folder / "in"
        staging = self.folder / f"staged{self.files}"
        table(self.spark, rows).coalesce(1).write.parquet(str(staging))
        (part,) = staging.glob("part-*.parquet")
        target.mkdir(exist_ok=True)
        os.utime(part, (1_700_000_000 + self.files * 10,) * 2)
        os.link(part, target / f"{self.files:04d}.parquet")

    def stream(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(self.folder / "in"))

    def run(self, df, mode, name="out", ends=True):
        """Run to the end of the input; returns the rows of every batch, in order.

        A stream with processing-time timeouts has no end of its own, as it always waits for the next timeout.
        """
        batches = []

        def keep(batch, batch_id):
            batches.append(batch.collect())

        trigger = {"availableNow": True} if ends else {"processingTime": "1 second"}
        writer = df.writeStream.outputMode(mode).trigger(**trigger)
        query = writer.option("checkpointLocation", str(self.folder / f"checkpoint-{name}")).foreachBatch(keep).start()
        if ends:
            query.awaitTermination()
        else:
            deadline = time.monotonic() + 60
            while len(batches) < self.files + 1 and query.isActive and time.monotonic() < deadline:
                time.sleep(0.2)
            query.stop()
            assert query.exception() is None and len(batches) > self.files
        return batches
