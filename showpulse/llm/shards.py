"""Shards by rendezvous hashing: every shard bids for every key, and the highest bid wins.

A key's shard depends on the key and the shards alone. A new shard takes the keys that it now bids highest for and no
other key moves. Bids are `-weight / ln(u)` with `u` uniform in (0, 1) from a hash of key and shard number, so a shard's
expected share is its share of the weights.

Rows: a null key is a key like any other. Null texts have no bytes and the checksum 0. Repeated rows get a slot each; which
of them gets which does not show. Input columns other than key and text play no part. An empty table gives an empty table.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAW = "key"
BUCKET_BITS = 8
"""Each shard's rows are numbered in 2**BUCKET_BITS ranges of the hash of their contents, in separate tasks, so different rows
of one key are in many."""

COPIES = 1 << 16
"""Equal rows that are numbered in one task; more of them are dealt to several."""

OVERHEAD = 16  # bytes that a stored row has besides its text


def shard_of(key: Column, weights: list[float]) -> Column:
    """The number of the shard that bids highest; of equal bids the smaller number wins."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    bids = F.transform(
        F.array(*(F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights))),
        lambda s: F.struct(
            # 52 bits of the hash, moved off both ends of the interval
            (-s["weight"] / F.ln((F.shiftrightunsigned(F.xxhash64(key, s["shard"]), 12) + 0.5) / float(2**52))).alias("bid"),
            (-s["shard"]).alias("last"),
        ),
    )
    return -F.array_max(bids)["last"]


def sharded(df: DataFrame, shards: int | list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, text_crc32, law, shard, slot and grown_shard of each row.

    `shards`: how many of equal weight, or their weights. `slot` counts the rows of a shard from 0 without gaps, in the
    order of a hash of key, size and checksum. `grown_shard` is the shard with one more shard of mean weight.
    """
    weights = [1.0] * shards if isinstance(shards, int) else list(shards)
    grown = [*weights, sum(weights) / len(weights)]
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).alias("key"),
        (F.octet_length(content) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    # Equal rows meet before the shuffle, so a key that a third of the rows have is a few rows here.
    counted = rows.groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    place = F.xxhash64("key", "size", "text_crc32", F.lit("slot"))
    dealt = counted.select(
        "*",
        shard_of(F.col("key"), weights).alias("shard"),
        shard_of(F.col("key"), grown).alias("grown_shard"),
        place.alias("place"),
        F.shiftrightunsigned(place, 64 - BUCKET_BITS).cast("int").alias("bucket"),
    )
    within = Window.partitionBy("shard", "bucket").orderBy("place", "key", "size", "text_crc32")
    numbered = dealt.withColumn("start", F.sum("copies").over(within) - F.col("copies"))
    # One row for each shard and bucket.
    buckets = dealt.groupBy("shard", "bucket").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket")
    offsets = buckets.select("shard", "bucket", (F.sum("rows").over(before) - F.col("rows")).alias("offset"))
    placed = numbered.join(offsets, ["shard", "bucket"])
    # Equal rows in ranges first, each of which may go to a task of its own.
    last = F.floor((F.col("copies") - 1) / COPIES)
    ranges = placed.withColumn("range", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    spread = ranges.where(last == 0).unionByName(ranges.where(last > 0).repartition("key", "size", "text_crc32", "range"))
    first = F.col("start") + F.col("offset") + F.col("range") * COPIES
    final = F.col("start") + F.col("offset") + F.least(F.col("copies"), (F.col("range") + 1) * COPIES) - 1
    return spread.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "grown_shard",
        F.explode(F.sequence(first, final)).alias("slot"),
    )
