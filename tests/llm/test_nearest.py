import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from showpulse.llm import nearest
from showpulse.llm.queries import op7_top_k

SCHEMA = "vec_id long, embedding array<float>, score string, v int, rank int"


def brute_force(rows, asked, k):
    """All integer inner products, sorted."""
    able = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, a in able:
        if asked(q):
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in able if i != q)
            want |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)}
    return want


def found(spark, rows, k=20):
    table = spark.createDataFrame([(i, v, "x", 1, 1) for i, v in rows], SCHEMA)
    got = nearest.top_k(nearest.quantised(table, "vec_id", "embedding"), F.col("id") % 20 == 0, k)
    return [(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()]


def odd_rows():
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(900)]
    rows += [(i, [0.5] * 12) for i in range(900, 1_200)]  # a third of all rows are equal, so most scores tie
    rows += [(1_200, None), (1_220, [None] * 12), (1_240, [math.nan] * 12), (1_260, [math.inf] + [0.0] * 11), (None, [9.0] * 12)]
    return rows + [(1_280, [0.0] * 12), (1_281, [-3.5] * 12), (1_300, [1e4] * 12)]


@pytest.mark.parametrize(("candidates", "queries"), [(4_096, 1_024), (100, 9)])
def test_equals_all_products(spark, monkeypatch, candidates, queries):
    """In one cell as in many, with ties, nulls, values without a bound and columns named as the operator's own."""
    monkeypatch.setattr(nearest, "CANDIDATES", candidates)
    monkeypatch.setattr(nearest, "QUERIES", queries)
    rows = odd_rows()
    got = found(spark, rows)
    assert len(got) == len(set(got))
    assert set(got) == brute_force(rows, lambda i: i % 20 == 0, 20)


def test_fewer_rows_than_wanted(spark):
    rows = [(0, [1.0, -1.0]), (1, [0.25, 0.5]), (20, [2.0, 2.0])]
    assert set(found(spark, rows)) == brute_force(rows, lambda i: i % 20 == 0, 20)
    assert found(spark, rows[:1]) == []


def test_values_beyond_floating_point(spark):
    rows = [(i, [float(2**20 + i), 2.0**20, -(2.0**12) * i]) for i in range(0, 60, 4)]
    assert set(found(spark, rows)) == brute_force(rows, lambda i: i % 20 == 0, 20)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_bounds_hold_after_every_step():
    rng = np.random.default_rng(3)
    rows, query = rng.integers(-90, 90, (50, 5)), rng.integers(-9, 9, 5)
    lists = nearest.Lists(np.arange(50), rows)
    positive, negative = np.maximum(query, 0), np.minimum(query, 0)
    lower, since, gaps = np.full(50, positive @ lists.values[0] + negative @ lists.values[-1]), 0, []
    assert lists.depths()[-1] == 50 and lists.depths() == sorted(set(lists.depths()))
    for depth in lists.depths():
        better_down, better_up, unread_down, unread_up, above_down, above_up = lists.step(since, depth)
        lower = lower + positive @ better_down + negative @ better_up
        gap = (positive * above_down) @ unread_down + (negative * above_up) @ unread_up
        assert (lower <= rows @ query).all() and (rows @ query <= lower + gap).all()
        gaps.append(gap.max())
        since = depth
    assert gaps == sorted(gaps, reverse=True) and gaps[-1] == 0


def test_most_queries_stop_before_the_lists_end(spark):
    """On the vectors of the larger table; what stops early is right all the same (see the products above)."""
    vectors = nearest.quantised(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), "vec_id", "embedding")
    shares = [r.read_share for r in nearest.top_k(vectors, F.col("id") % 20 == 0).groupBy("query_id").agg(F.max("read_share").alias("read_share")).collect()]
    assert len(shares) >= 100 and sum(share < 1 for share in shares) > 0.8 * len(shares)


def test_rows_that_share_a_key_are_one(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)] + [(20, [0.25, -3.0]), (20, [0.0, 9.0]), (33, [-1.0, 5.0]), (33, [-1.0, 5.0])]
    one = {}
    for i, v in rows:
        one[i] = min(one.get(i, v), v)
    got = found(spark, rows, 5)
    assert len(got) == len(set(got)) == 15
    assert set(got) == brute_force(list(one.items()), lambda i: i % 20 == 0, 5)


def test_query_asks_for_every_twentieth_row(spark, sf_dir):
    rows = op7_top_k(spark, sf_dir)
    asked = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id % 20 = 0").count()
    assert rows.select("query_id").distinct().count() == asked and rows.count() == 20 * asked
