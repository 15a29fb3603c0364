"""Bounded samples of labelled rows, the same on every read of a table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def sample_per_class(df: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """About `rows` rows of each class of `label`, all of a smaller class: rows whose hashed key is below the class's share.

    The counts come from the label column alone, and classes are taken to be few. No row is moved.
    """
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect() if r[label] is not None}
    if not counts:
        return df.limit(0)
    share = F.create_map(*(F.lit(x) for c, n in counts.items() for x in (c, min(1.0, rows / n))))
    drawn = F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 12) / float(2**52)
    return df.where(drawn < share[F.col(label)])
