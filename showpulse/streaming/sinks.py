"""What streams store: views by date, upserts by key bucket, sketches of watchers, lines of counts."""

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showpulse.functions.schema import VIEW
from showpulse.operators import sketches
from showpulse.operators.columns import names
from showpulse.operators.counts import pair_lines
from showpulse.operators.latest import latest
from showpulse.operators.views import REQUIRED, last_per_second, split_storable, view_rows
from showpulse.operators.windows import LENGTH, SLIDE, pane_ends, sliding_from_panes
from showpulse.streaming import tables

DATE = "record_date"
BUCKET = "key_bucket"
BUCKETS = 64
"""Key buckets of an upsert table; a merge writes those whose keys have changed."""


def append_views(
    df: DataFrame,
    batch_id: int,
    path: str,
    dedup: str | None = None,
    written_at: Column | None = None,
    ts: str = "event_time",
    order: str | list[str] = "event_id",
    rejected: str | None = None,
    required: tuple[str, ...] = REQUIRED,
) -> None:
    """Store the views of one batch, by date. Events that cannot be stored go to the table `rejected`, if named.

    `dedup="user_second"` keeps the last event of each user and second of `ts`.
    """
    if dedup not in (None, "user_second"):
        raise ValueError(f"unknown dedup: {dedup}")
    stored, lacking = split_storable(df, required)
    if dedup == "user_second":
        stored = last_per_second(stored, "user_id", ts, order)
    tables.append_batch(view_rows(stored, written_at), batch_id, path, [DATE])
    if rejected is not None:
        tables.write_batch(lacking, batch_id, rejected)


def stored_views(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Stored views of finished batches; with `dates`, of these dates, for which only their folders are listed.

    Readers that use few columns load no more than those.
    """
    found = tables.rows(spark, path, DATE, VIEW, dates)
    return spark.createDataFrame([], VIEW) if found is None else found


def merge_views(spark: SparkSession, path: str) -> None:
    """Move finished batches of views into one folder per date; only dates that they touch are written."""
    tables.merge(spark, path, DATE, lambda rows: rows, schema=VIEW)


def upsert_log(df: DataFrame, batch_id: int, path: str) -> None:
    """Add a batch of upserts to the table at `path`."""
    tables.append_batch(df, batch_id, path)


def upserted(
    spark: SparkSession, path: str, keys: str | list[str], order: str | list[str] = "batch_id"
) -> DataFrame:
    """The table at `path`: the last row of each key by `order`, of equals the one of the last batch.

    `order` is the order of the rows of a key within the table, say its window or visit; rows of one key and order are
    versions of each other, the newest of which is in the newest batch.
    """
    rows = tables.rows(spark, path, BUCKET)
    if rows is None:
        raise ValueError(f"no complete batch at {path}")
    return _latest(rows, keys, order)


def _latest(rows: DataFrame, keys: str | list[str], order: str | list[str]) -> DataFrame:
    return latest(rows, keys, [*(name for name in names(order) if name != "batch_id"), "batch_id"])


def merge_upserts(
    spark: SparkSession, path: str, keys: str | list[str], order: str | list[str] = "batch_id", buckets: int = BUCKETS
) -> None:
    """Move finished batches of upserts into key buckets, where only the last row of each key stays. Buckets without new rows
    are neither read nor written; `buckets` must stay the same.

    `keys` must be those of the table: if one batch holds two rows of a key, one of them would be lost, so that is an error.
    """
    key_names = names(keys)

    def check(new: DataFrame) -> None:
        if new.groupBy("batch_id", *key_names).count().where("count > 1").take(1):
            raise ValueError(f"{key_names} are not the whole key of {path}")

    def place(rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*key_names), F.lit(buckets)).cast("int"))

    tables.merge(spark, path, BUCKET, lambda rows: _latest(rows, keys, order), place, check)


def read_totals(spark: SparkSession, path: str, keys: str | list[str] = ("user_id", "show_id")) -> DataFrame:
    """The newest visit of each key with its newest total; for users alone, of the show whose visit began last."""
    return upserted(spark, path, keys, ["visit_start", "show_id", "visit_end"])


PANE = ["user_id", "show_id", "window_start"]
"""The whole key of a table of panes."""


def read_windows(
    spark: SparkSession, path: str, keys: str | list[str] = ("user_id", "show_id"), length: str = LENGTH
) -> DataFrame:
    """The newest window of each key with its newest count, from a table of panes.

    A key's newest window begins with its newest pane, beyond which it has no event, so the pane's count is the window's.
    """
    return pane_ends(upserted(spark, path, keys, ["window_start", "show_id"]), length)


def read_sliding(
    spark: SparkSession,
    path: str,
    keys: str | list[str] = ("user_id", "show_id"),
    length: str = LENGTH,
    slide: str = SLIDE,
) -> DataFrame:
    """All windows of each key, put together from a table of panes."""
    return sliding_from_panes(upserted(spark, path, [*names(keys), "window_start"]), keys, length, slide)


def append_sketches(
    df: DataFrame, batch_id: int, path: str, show: str = "show_id", user: str = "user_id", date: str = DATE
) -> None:
    """Store one sketch of the users of each show and date of a batch."""
    by_date = sketches.watcher_sketches(df, [show, date], user)
    tables.append_batch(by_date.withColumnRenamed(show, "show_id").withColumnRenamed(date, DATE), batch_id, path, [DATE])


def merge_sketches(spark: SparkSession, path: str) -> None:
    """Move finished batches into one folder per date, with one sketch per show."""
    tables.merge(spark, path, DATE, lambda rows: sketches.united(rows, ["show_id", DATE]), schema=sketches.STORED)


def read_watchers(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """Watchers per show, on `dates` or ever, from the sketches alone; see `sketches` for how far they may be off."""
    found = tables.rows(spark, path, DATE, sketches.STORED, dates)
    stored = spark.createDataFrame([], sketches.STORED) if found is None else found
    return sketches.watchers(stored, ["show_id"])


def write_pairs_text(df: DataFrame, key: str, count: str, path: str) -> None:
    """One `(key,count)` line per group."""
    pair_lines(df, key, count).write.mode("overwrite").text(path)


def write_counts(df: DataFrame, path: str) -> None:
    """Replace the table: every count is recomputed, so this updates every key."""
    df.write.mode("overwrite").parquet(path)


def shared(*writers):
    """A batch function that hands one micro-batch to several writers and reads its source once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write
