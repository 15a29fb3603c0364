"""Exact top-k inner products by reading sorted lists, without random access to single scores until the end.

Each component of the candidates is a list sorted by value. A query reads the lists of its positive components from the
largest value down and those of its negative ones from the smallest up, in steps, all to the same depth. What has been read
bounds every candidate's score: an unread component is no better than the last value read and no worse than the end of
its list. A step adds what it has read to the lower bounds and narrows the gaps above them. A query stops reading when only
a few candidates have an upper bound that reaches the k-th best lower bound: no other can be among its k best. The scores of
these few are then resolved in full. Candidates and queries are dealt into cells of bounded size, each cell gives its k best,
and the best of those are the answer.

Rows: null keys, null vectors and vectors with null, NaN or infinite components take no part. Of rows that share a key, one
takes part, that of the least vector in order. Shorter vectors count as padded with zeros. A query is not its own candidate.
Equal scores go to the smaller key. With fewer than k candidates all are returned; an empty table gives an empty table. Other
columns play no part.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES = 4_096
QUERIES = 1_024
"""Rows of each side that meet in one cell, about."""
STEP = 0.5
"""Share of what is left of the lists that a step reads."""
LEAST = 1 / 64
"""Share of the lists below which a step reads all that is left."""
FEW = 4
"""Candidates for each wanted one whose scores are resolved in full rather than bounded further."""


def quantised(df: DataFrame, key: str, vector: str, factor: int = 64) -> DataFrame:
    """Keys and the vectors' components as floor(factor * x), of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")).alias("v"),
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    rows = column.combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.chunk(0)
    lengths = np.asarray(rows.value_lengths())
    values = np.asarray(rows.flatten())
    if (lengths == width).all():
        return values.reshape(len(rows), width)
    out = np.zeros((len(rows), width), np.int64)
    out[np.repeat(np.arange(len(rows)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


class Lists:
    """The sorted lists of a block of candidates."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows.astype(np.float64)
        self.n = len(ids)
        by = np.argsort(rows, axis=0, kind="stable")
        self.place = np.empty_like(by)
        np.put_along_axis(self.place, by, np.arange(self.n)[:, None], 0)
        self.values = np.take_along_axis(self.rows, by, 0)

    def depths(self) -> list[int]:
        """How deep the lists have been read after each step."""
        depths, left = [], self.n
        while left > self.n * LEAST:
            left -= max(1, round(left * STEP))
            depths.append(self.n - left)
        return [*depths, self.n] if left else depths

    def step(self, since: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What reading from `since` to `depth` tells, for lists read downwards and for lists read upwards: how much better
        than the end of its list each component that was read now is, which are unread, and how far above the end of its
        list an unread component may be.
        """
        n, rows, values, place = self.n, self.rows, self.values, self.place
        now_down, now_up = (place >= n - depth) & (place < n - since), (place < depth) & (place >= since)
        return (
            np.where(now_down, rows - values[0], 0.0).T,
            np.where(now_up, rows - values[n - 1], 0.0).T,
            (place < n - depth).astype(np.float64).T,
            (place >= depth).astype(np.float64).T,
            values[n - depth] - values[0],
            values[depth - 1] - values[n - 1],
        )


def best_of(lists: Lists, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query, candidate, score and share of the lists that was read, for each query's k best of a block; ties to the smaller id."""
    found: list[tuple] = []
    n, exact = lists.n, queries.astype(np.float64)
    todo = np.arange(len(queries))
    positive, negative = np.maximum(exact, 0), np.minimum(exact, 0)
    # With nothing read every component is at the end of its list. Values are integers below 2**52, so sums are exact.
    lower = np.repeat((positive @ lists.values[0] + negative @ lists.values[n - 1])[:, None], n, 1)
    lower[query_ids[:, None] == lists.ids[None, :]] = -np.inf
    since = 0
    for depth in lists.depths():
        better_down, better_up, unread_down, unread_up, above_down, above_up = lists.step(since, depth)
        lower += positive[todo] @ better_down + negative[todo] @ better_up
        gap = (positive[todo] * above_down) @ unread_down + (negative[todo] * above_up) @ unread_up
        bar = np.partition(lower, n - k, 1)[:, n - k] if n > k else np.full(len(todo), -np.inf)
        able = (lower + gap >= bar[:, None]) & (lower > -np.inf)
        done = (able.sum(1) <= FEW * k) | (depth == n)
        for at in np.flatnonzero(done):
            q, chosen = todo[at], np.flatnonzero(able[at])
            scores = lists.rows[chosen] @ exact[q]
            by = np.lexsort((lists.ids[chosen], -scores))[:k]
            found.append((query_ids[q], lists.ids[chosen][by], scores[by], depth / n))
        todo, lower, since = todo[~done], lower[~done], depth
        if not len(todo):
            break
    lengths = [len(ids) for _, ids, _, _ in found]
    return (
        np.repeat([q for q, _, _, _ in found], lengths).astype(np.int64),
        np.concatenate([ids for _, ids, _, _ in found]),
        np.concatenate([scores for _, _, scores, _ in found]).astype(np.int64),
        np.repeat([share for _, _, _, share in found], lengths).astype(np.float64),
    )


def plain(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The same for values beyond the exact range of floating point: full scores in 64-bit integers."""
    out: list[list] = [[], [], [], []]
    for q, vector in zip(query_ids, queries, strict=True):
        others = np.flatnonzero(ids != q)
        scores = (rows[others] * vector).sum(1)
        by = np.lexsort((ids[others], ~scores))[:k]
        for column, part in zip(out, (np.full(len(by), q), ids[others][by], scores[by], np.ones(len(by))), strict=True):
            column.append(part)
    return tuple(map(np.concatenate, out))


def top_k(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k best of all rows for each row where `queries` holds, and read_share, the
    share of the lists that was read in the cell where a row was found.

    `vectors` has the columns `id` and `v`, as `quantised` gives them. Rows of both sides are copied once for each block of
    the other side; a cell holds about CANDIDATES and QUERIES rows whatever the number of either.
    """
    vectors = vectors.groupBy("id").agg(F.min("v").alias("v"))
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.count_if(queries).alias("q"), F.max(F.size("v")).alias("width")).first()
    width = sizes.width or 0
    across, down = max(1, -(-sizes.n // CANDIDATES)), max(1, -(-sizes.q // QUERIES))
    cell = F.col("across") * down + F.col("down")
    block = F.xxhash64("id", F.lit("block"))
    # Names of their own: both sides come from the same rows.
    asked = vectors.where(queries).select(
        F.col("id").alias("query"),
        F.col("v").alias("asked"),
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("across"),
        F.pmod(block, F.lit(down)).alias("down"),
    )
    offered = vectors.select(
        F.col("id").alias("candidate"),
        F.col("v").alias("offered"),
        F.pmod(block, F.lit(across)).alias("across"),
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("down"),
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score", "read_share"]
        if not left.num_rows or not right.num_rows or not width:
            made = (np.zeros(0, np.int64),) * 3 + (np.zeros(0),)
        else:
            query_ids, ids = np.asarray(left.column("query")), np.asarray(right.column("candidate"))
            asks, rows = matrix(left.column("asked"), width), matrix(right.column("offered"), width)
            most = float(np.abs(asks.astype(np.float64)).max()) * float(np.abs(rows.astype(np.float64)).max()) * width
            made = (
                best_of(Lists(ids, rows), query_ids, asks, k) if most < 2.0**52 else plain(ids, rows, query_ids, asks, k)
            )
        return pa.table([pa.array(a) for a in made], names)

    met = (
        asked.withColumn("cell", cell)
        .groupBy("cell")
        .cogroup(offered.withColumn("cell", cell).groupBy("cell"))
        .applyInArrow(meet, "query_id long, vec_id long, score long, read_share double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
