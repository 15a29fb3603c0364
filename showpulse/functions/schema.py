"""Event and table layouts."""

from pyspark.sql import types as T

# JSON field name -> event column, in wire order.
WIRE_NAMES = {
    "userId": "user_id",
    "userGender": "user_gender",
    "userAge": "user_age",
    "season": "season",
    "episode": "episode",
    "showId": "show_id",
    "showName": "show_name",
    "timestamp": "event_time",
    "rating": "rating",
    "episodeLength": "episode_length",
}

# Fields that are accepted when read but never written.
NEVER_SENT = ("userAge", "showName")

# Time text of a message and the zone it is written in.
WIRE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
WIRE_ZONE = "-07:00"

EVENT = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("user_gender", T.StringType()),
        T.StructField("user_age", T.StringType()),
        T.StructField("season", T.StringType()),
        T.StructField("episode", T.StringType()),
        T.StructField("show_id", T.StringType()),
        T.StructField("show_name", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("episode_length", T.DoubleType()),
    ]
)

# One stored view; the nested columns are the column families of the stored table.
VIEW = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("written_at", T.TimestampType()),
        T.StructField(
            "watchedEpisode",
            T.StructType(
                [
                    T.StructField("Season", T.StringType()),
                    T.StructField("Episode", T.StringType()),
                    T.StructField("ShowId", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "watchDetails",
            T.StructType(
                [
                    T.StructField("rating", T.DoubleType()),
                    T.StructField("time", T.DoubleType()),
                ]
            ),
        ),
        T.StructField(
            "userDetails",
            T.StructType(
                [
                    T.StructField("userId", T.StringType()),
                    T.StructField("userGender", T.StringType()),
                    T.StructField("watchTime", T.TimestampType()),
                ]
            ),
        ),
        T.StructField("record_date", T.StringType()),
    ]
)
