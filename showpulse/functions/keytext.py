"""Text forms of keys, times and cells of the stored tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time text inside row keys, and its part after the weekday (Spark formats E, but does not parse it).
DATE_TEXT_FORMAT = "E MMM dd HH:mm:ss z yyyy"
DATE_TEXT_AFTER_WEEKDAY = "MMM dd HH:mm:ss z yyyy"


def date_text(time: Column) -> Column:
    """A time to the second with its zone, such as `Mon Jan 01 00:00:07 UTC 2024`."""
    return F.date_format(time, DATE_TEXT_FORMAT)


def parse_date_text(text: Column) -> Column:
    return F.try_to_timestamp(F.substr(text, F.lit(5)), F.lit(DATE_TEXT_AFTER_WEEKDAY))


def record_date(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def view_key(user: Column, time: Column) -> Column:
    """Row key of a stored view: `user;time`."""
    return F.concat_ws(";", user, date_text(time))


def window_key(user: Column, show: Column) -> Column:
    """Row key of a window count: `user=>show`."""
    return F.concat_ws("=>", user, show)


def count_key(user: Column, show: Column) -> Column:
    """Row key of a batch count. It has no separator, so it labels a group and must not define one."""
    return F.concat(user.cast("string"), show.cast("string"))


def cell(value: Column) -> Column:
    """A value as stored bytes; an absent value is stored as the text `null`."""
    return F.encode(F.coalesce(value.cast("string"), F.lit("null")), "UTF-8")


def cell_text(stored: Column) -> Column:
    return F.decode(stored, "UTF-8")


def cell_number(stored: Column) -> Column:
    """The number in a stored cell, null where the cell holds no number."""
    return cell_text(stored).try_cast("double")


def pair_line(key: Column, count: Column) -> Column:
    """A count as a line of text: `(key,count)`."""
    return F.format_string("(%s,%d)", key, count)
