import math
import struct
from collections import Counter
from zlib import crc32

import xxhash
from pyspark.sql import functions as F

from showpulse.llm import shards

SCHEMA = "doc_id long, text string, shard string, size int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def test_rows_keep_their_contents_and_slots_have_no_gaps(spark):
    rows = [(i % 900, None if i % 7 == 0 else "é" * (i % 5)) for i in range(2_000)] + [(None, None)] * 3 + [(5, "hot")] * 1_500
    got = shards.sharded(frame(spark, rows), 40).collect()
    want = Counter((i, len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    for shard in range(40):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
    assert {r.law for r in got} == {"key"}
    assert all(r.grown_shard in (r.shard, 40) for r in got)
    assert len({(r.doc_id, r.shard) for r in got}) == len({i for i, _ in rows})


def test_shares_follow_the_weights(spark):
    keys = spark.range(60_000).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("x"))
    got = shards.sharded(keys, [1.0, 2.0, 3.0])
    counts = {r.shard: r["count"] for r in got.groupBy("shard").count().collect()}
    for shard in range(3):
        assert abs(counts[shard] / 60_000 - (shard + 1) / 6) < 0.01
    moved = got.where("grown_shard != shard")
    assert abs(moved.count() / 60_000 - 1 / 4) < 0.01
    assert moved.where("grown_shard != 3").count() == 0


def test_places_do_not_depend_on_the_other_rows(spark):
    rows = [(i, str(i)) for i in range(500)]
    whole = {r.doc_id: (r.shard, r.grown_shard) for r in shards.sharded(frame(spark, rows), 40).collect()}
    part = {r.doc_id: (r.shard, r.grown_shard) for r in shards.sharded(frame(spark, rows[::3]), 40).collect()}
    assert part.items() <= whole.items()


def test_every_shard_bids_and_the_highest_bid_wins(spark):
    """All bids by hand: the hash of a number is that of its bytes, each value's hash seeding the next one's."""
    weights = [0.5, 3.0, 1.0, 1.0, 2.25]

    def bid(key, shard, weight):
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), xxhash.xxh64_intdigest(struct.pack("<q", key), 42))
        return -weight / math.log(((h >> 12) + 0.5) / 2**52)

    def winner(key, weights):
        return max(range(len(weights)), key=lambda i: (bid(key, i, weights[i]), -i))

    grown = [*weights, sum(weights) / len(weights)]
    for r in shards.sharded(frame(spark, [(i * 7 - 900, "t") for i in range(400)]), weights).collect():
        assert (r.shard, r.grown_shard) == (winner(r.doc_id, weights), winner(r.doc_id, grown))


def test_hot_rows_and_hot_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(shards, "COPIES", 100)
    rows = [(None, "same")] * 950 + [(None, f"t{i}") for i in range(900)] + [(7, f"u{i}") for i in range(900)]
    result = shards.sharded(frame(spark, rows), 3)
    got = result.collect()
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((i, crc32(t.encode())) for i, t in rows)
    for shard in range(3):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
    # A key's rows are numbered in many ranges of their hash.
    places = {r.slot // 20 for r in got if r.doc_id == 7}
    assert len(places) > 40


def test_empty_table(spark):
    assert shards.sharded(frame(spark, []), 40).count() == 0
