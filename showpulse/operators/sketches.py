"""Distinct users as sketches that can be kept, united and read at any time, without the events they were made of.

A sketch holds at most 2**LG_K slots. While it has seen few users it lists their hashes, and its answer is exact but for
collisions; beyond, its relative error is about 1.04 / sqrt(2**LG_K) (one standard deviation), 0.8 % at 14.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 14

STORED = T.StructType(
    [
        T.StructField("show_id", T.StringType()),
        T.StructField("users", T.BinaryType()),
        T.StructField("record_date", T.StringType()),
    ]
)


def watcher_sketches(df: DataFrame, keys: list[str], user: str = "user_id", lg_k: int = LG_K) -> DataFrame:
    """One sketch of the users of each group, in `users`; events without a user are not counted."""
    return df.where(F.col(user).isNotNull()).groupBy(*keys).agg(F.hll_sketch_agg(user, F.lit(lg_k)).alias("users"))


def united(df: DataFrame, keys: list[str]) -> DataFrame:
    """One sketch for each group, of the users of all its sketches."""
    return df.groupBy(*keys).agg(F.hll_union_agg("users").alias("users"))


def watchers(df: DataFrame, keys: list[str]) -> DataFrame:
    """The number of users of each group of sketches."""
    return df.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("watchers"))
