"""Counts over all stored views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showpulse.functions.keytext import count_key, pair_line
from showpulse.operators.columns import names, whole
from showpulse.operators.totals import KEYS


def count_by(df: DataFrame, keys: str | list[str] = KEYS, name: str = "total_count") -> DataFrame:
    """Events per key; an event whose key has a null part is a group of its own, with the count 1. On a stream in update mode
    this is the running total without a reset, and events with such keys are left out.
    """
    keys = names(keys)
    counts = df.where(whole(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    if df.isStreaming:
        return counts
    return counts.unionByName(df.where(~whole(keys)).select(*keys, F.lit(1).cast("long").alias(name)))


def view_counts(df: DataFrame, user: str = "user_id", show: str = "show_id") -> DataFrame:
    """Views per user and show, labelled with the text key `count_key`."""
    counts = count_by(df, [user, show], "view_count")
    return counts.select(count_key(F.col(user), F.col(show)).alias("count_key"), user, show, "view_count")


def pair_lines(df: DataFrame, key: str, count: str) -> DataFrame:
    """Each group as a line of text, `(key,count)`, in the column `value`."""
    return df.select(pair_line(F.col(key), F.col(count)).alias("value"))


def views_per_show(df: DataFrame, show: str = "show_id") -> DataFrame:
    return count_by(df, show, "views")


def watchers_per_show(df: DataFrame, show: str = "show_id", user: str = "user_id", approx: bool = False) -> DataFrame:
    users = F.approx_count_distinct(user) if approx else F.count_distinct(user)
    return df.groupBy(show).agg(users.alias("watchers"))


def group_count(df: DataFrame, keys: str | list[str] = KEYS) -> DataFrame:
    """One row: how many groups the keys form; a row whose key has a null part is one of its own."""
    keys = names(keys)
    groups = df.select(*keys).where(whole(keys)).distinct().unionByName(df.select(*keys).where(~whole(keys)))
    return groups.agg(F.count(F.lit(1)).alias("groups"))
