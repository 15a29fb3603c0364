"""Upsert reads: the last row written for each key."""

from pyspark.sql import DataFrame

from showpulse.operators.columns import names, pick_row


def latest(df: DataFrame, keys: str | list[str], order: str | list[str]) -> DataFrame:
    return pick_row(df, names(keys), names(order), latest=True).select("_row.*")
