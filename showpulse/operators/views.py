"""Stored views: what is storable, the nested row, the text cells, and the way back to events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showpulse.functions import keytext
from showpulse.operators.columns import names, pick_row

REQUIRED = ("user_id", "show_id", "season", "episode")


def split_storable(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> tuple[DataFrame, DataFrame]:
    """(events that can be stored, events that lack a required value); together they hold every event."""
    lacks = F.lit(False)
    for name in required:
        lacks = lacks | F.col(name).isNull()
    return df.where(~lacks), df.where(lacks)


def view_rows(df: DataFrame, written_at: Column | None = None) -> DataFrame:
    """Events as nested stored views. `written_at` defaults to the current time."""
    stamp = F.current_timestamp() if written_at is None else written_at
    return df.select(
        keytext.view_key(F.col("user_id"), stamp).alias("row_key"),
        stamp.alias("written_at"),
        F.struct(
            F.col("season").alias("Season"), F.col("episode").alias("Episode"), F.col("show_id").alias("ShowId")
        ).alias("watchedEpisode"),
        F.struct(F.col("rating"), F.col("episode_length").alias("time")).alias("watchDetails"),
        F.struct(
            F.col("user_id").alias("userId"),
            F.col("user_gender").alias("userGender"),
            F.col("event_time").alias("watchTime"),
        ).alias("userDetails"),
        keytext.record_date(stamp).alias("record_date"),
    )


def last_per_second(
    df: DataFrame, user: str = "user_id", ts: str = "ts", order: str | list[str] = "event_id"
) -> DataFrame:
    """The last event of each user in each second: what remains if views are stored under `user;second`."""
    second = F.date_trunc("second", F.col(ts)).alias("_second")
    return pick_row(df, [user, second], [ts, *names(order)], latest=True).select("_row.*")


def view_cells(views: DataFrame) -> DataFrame:
    """Stored views with every value as UTF-8 text bytes and times as date text."""
    episode, details, user = (F.col(family) for family in ("watchedEpisode", "watchDetails", "userDetails"))
    return views.select(
        keytext.cell(F.col("row_key")).alias("row_key"),
        F.struct(*(keytext.cell(episode[name]).alias(name) for name in ("Season", "Episode", "ShowId"))).alias(
            "watchedEpisode"
        ),
        F.struct(*(keytext.cell(details[name]).alias(name) for name in ("rating", "time"))).alias("watchDetails"),
        F.struct(
            keytext.cell(user["userId"]).alias("userId"),
            keytext.cell(user["userGender"]).alias("userGender"),
            keytext.cell(keytext.date_text(user["watchTime"])).alias("watchTime"),
        ).alias("userDetails"),
    )


def parse_view_keys(df: DataFrame, key: str = "row_key") -> DataFrame:
    """Add `user_id` and `written_at`, taken from the text key `user;time`."""
    parts = F.split(F.col(key), ";")
    return df.withColumns({"user_id": F.get(parts, F.lit(0)), "written_at": keytext.parse_date_text(F.get(parts, F.lit(1)))})


def cells_to_events(cells: DataFrame) -> DataFrame:
    """Events from text cells, with user and write time from the row key."""
    episode, details, user = (F.col(family) for family in ("watchedEpisode", "watchDetails", "userDetails"))
    keyed = parse_view_keys(cells.withColumn("row_key", keytext.cell_text(F.col("row_key"))))
    return keyed.select(
        "user_id",
        keytext.cell_text(user["userGender"]).alias("user_gender"),
        keytext.cell_text(episode["ShowId"]).alias("show_id"),
        keytext.cell_text(episode["Episode"]).alias("episode"),
        keytext.cell_text(episode["Season"]).alias("season"),
        keytext.parse_date_text(keytext.cell_text(user["watchTime"])).alias("event_time"),
        keytext.cell_number(details["rating"]).alias("rating"),
        keytext.cell_number(details["time"]).alias("episode_length"),
        "written_at",
    )


def views_to_events(views: DataFrame) -> DataFrame:
    """Events from nested stored views."""
    return views.select(
        F.col("userDetails.userId").alias("user_id"),
        F.col("userDetails.userGender").alias("user_gender"),
        F.col("watchedEpisode.ShowId").alias("show_id"),
        F.col("watchedEpisode.Episode").alias("episode"),
        F.col("watchedEpisode.Season").alias("season"),
        F.col("userDetails.watchTime").alias("event_time"),
        F.col("watchDetails.rating").alias("rating"),
        F.col("watchDetails.time").alias("episode_length"),
        "written_at",
    )


def traffic_rows(df: DataFrame, stamp: Column | None = None, keys: tuple[str, ...] = ("user_id", "show_id")) -> DataFrame:
    """Total or window counts as stored: keys, count, time stamp and date; the stamp defaults to the current time."""
    time = F.current_timestamp() if stamp is None else stamp
    return df.select(*keys, "total_count", time.alias("time_stamp"), keytext.record_date(time).alias("record_date"))
