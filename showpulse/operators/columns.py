"""Small helpers shared by the operators."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def whole(keys: Sequence[str]) -> Column:
    """Whether no part of a key is null. Two keys are the same only if they are whole and equal, so a row whose key is not
    whole is alone in its group.
    """
    return reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in keys), F.lit(True))


def pick_row(df: DataFrame, keys: list, by: Sequence[str], latest: bool = False, **also: Column) -> DataFrame:
    """The whole first (or latest) row of each group as `_row`, next to the aggregates in `also`.

    An aggregate rather than a ranking: each task keeps one row per group before the shuffle, so a group that
    holds a large share of the table costs no more than any other.
    """
    pick = F.max_by if latest else F.min_by
    row = pick(F.struct(*df.columns), F.struct(*by)).alias("_row")
    return df.groupBy(*keys).agg(row, *(value.alias(name) for name, value in also.items()))


def attach(df: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a broadcast side whose size the caller has bounded; a null key finds a null key."""
    renamed = side.withColumnsRenamed({name: f"_on_{name}" for name in on})
    match = reduce(lambda a, b: a & b, (df[name].eqNullSafe(renamed[f"_on_{name}"]) for name in on))
    return df.join(F.broadcast(renamed), match, how).drop(*(f"_on_{name}" for name in on))
