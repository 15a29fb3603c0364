"""Durations are written as Spark interval text, such as "3600 seconds"."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def interval(duration: str) -> Column:
    return F.expr(f"INTERVAL {duration}")


def micros(duration: str) -> int:
    """The same duration as a number of microseconds, for code inside Arrow tasks."""
    return pd.Timedelta(duration) // pd.Timedelta(microseconds=1)


def exceeds(later: Column, earlier: Column, duration: str) -> Column:
    """True where more than `duration` lies between the two times; exactly `duration` is not more."""
    return later > earlier + interval(duration)
