"""JSON messages to event rows and back."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showpulse.functions.schema import NEVER_SENT, WIRE_NAMES, WIRE_TIME_FORMAT, WIRE_ZONE

# Every field is read as text, so that a quoted number is as good as a bare one.
_TEXT_SCHEMA = ", ".join(f"{name} STRING" for name in WIRE_NAMES) + ", _unreadable STRING"
_READ_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"}


def _given(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def parse_events(df: DataFrame, value: str = "value", zone: str = WIRE_ZONE) -> DataFrame:
    """Add the event columns and `bad` to every message; `bad` messages have no usable event.

    A message is bad if it is not a JSON object, or if its time or one of its numbers is not readable.
    Unknown fields are ignored, absent numbers are 0. Times are texts of the wire's format, or milliseconds since 1970.
    """
    raw = F.col("_raw")
    message = F.from_json(F.col(value).cast("string"), _TEXT_SCHEMA, _READ_OPTIONS)
    # A generator of one row: filters and projections above it share one parse instead of each repeating it.
    parsed = df.select(*df.columns, F.inline(F.array(F.struct(message.alias("_raw")))))
    time_text = _given(raw["timestamp"])
    rating_text = _given(raw["rating"])
    length_text = _given(raw["episodeLength"])
    written = F.try_to_timestamp(F.concat(time_text, F.lit(zone)), F.lit(WIRE_TIME_FORMAT + "XXX"))
    millis = F.when(time_text.rlike("^-?[0-9]{1,15}$"), time_text.cast("long"))
    time = F.coalesce(F.timestamp_millis(millis), written)
    rating = rating_text.try_cast("double")
    length = length_text.try_cast("double")
    unreadable = (
        raw.isNull()
        | raw["_unreadable"].isNotNull()
        | (time_text.isNotNull() & time.isNull())
        | (rating_text.isNotNull() & rating.isNull())
        | (length_text.isNotNull() & length.isNull())
    )
    columns = {column: raw[name] for name, column in WIRE_NAMES.items()}
    columns |= {
        "event_time": time,
        "rating": F.coalesce(rating, F.lit(0.0)),
        "episode_length": F.coalesce(length, F.lit(0.0)),
    }
    events = [column.alias(name) for name, column in columns.items()]
    return parsed.select(*df.columns, *events, F.coalesce(unreadable, F.lit(True)).alias("bad"))


def decode_events(df: DataFrame, value: str = "value", zone: str = WIRE_ZONE) -> tuple[DataFrame, DataFrame]:
    """Split messages into (events, quarantined messages); together they hold every message."""
    parsed = parse_events(df, value, zone)
    return parsed.where(~F.col("bad")).drop("bad", value), parsed.where("bad").select(*df.columns)


def encode_events(df: DataFrame, zone: str = WIRE_ZONE, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON message per event in the column `value`, next to the columns in `keep`.

    Times lose their sub-second part.
    """
    sent = [
        F.col(column).cast("timestamp" if name == "timestamp" else df.schema[column].dataType).alias(name)
        for name, column in WIRE_NAMES.items()
        if name not in NEVER_SENT
    ]
    options = {"timestampFormat": WIRE_TIME_FORMAT, "timeZone": zone, "ignoreNullFields": "false"}
    return df.select(F.to_json(F.struct(*sent), options).alias("value"), *keep)
