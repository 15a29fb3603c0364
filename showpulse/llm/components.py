"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showpulse.sources.shared import settled

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node of its component, for every node of `edges` (columns a and b, longs).

    Large-star and small-star steps in turn: each node links its larger neighbours, then all its neighbours, to the least
    of them, until nothing changes. Both are a group's minimum and a join, so no task holds a node's neighbours at once; the
    number of steps grows with the logarithm of a component's length. Every round is written to the shared folder.
    """
    links = settled(_ordered(edges))
    before = None
    for _ in range(ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both, larger_only=True)
        small = _to_least(large, larger_only=False)
        links = settled(small.distinct())
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 2**31).alias("s")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, its larger node as a."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link neighbours b of each node a, those larger than a or the others, to the least neighbour, a itself included."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    if larger_only:
        joined = edges.where("b > a").join(least, "a")
        made = joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        joined = edges.join(least, "a")
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return made.where("a <> b")
