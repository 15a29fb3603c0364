"""Similarity join of word shingle sets by chosen paths, and the classes of near copies that it finds.

Texts whose shingle sets are equal are one set from the start. A set is known by SIGNATURE minwise tokens; two sets share
each of them with a probability equal to their Jaccard similarity. A run starts with all sets in one bucket. A bucket picks
some of the SIGNATURE coordinates by a hash of its path and deals its sets into a child bucket for each picked coordinate and
token there, so sets that share the token meet again; a bucket picks so many coordinates that a similar pair meets in more
than one child on average. Buckets small enough are compared by brute force; others are split again, down to DEPTH. Runs are repeated
until a pair at the threshold is missed with a probability below 1 - RECALL.

In a bucket, signatures are compared, and each group of sets that may be similar is kept as a tree, not as all its pairs.
Within the groups that the trees connect all pairs are compared exactly, set by set and in blocks of bounded size, again keeping
trees and numbers of links. No pair beyond the trees' edges leaves a task.

Texts: words are runs of non-space characters in lower case. A text of fewer than WIDTH words is one shingle. Null texts,
and texts without words, are similar to nothing; without words, equal texts are still one class. Repeated rows keep a row
each. Texts are read whole, whatever their length; a task holds the shingles of one text, and of two blocks. Other columns play no part. An empty table gives an empty table.
"""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showpulse.llm.columns import add_columns
from showpulse.llm.components import components
from showpulse.sources.shared import settled

WIDTH = 5
SIMILARITY = 0.8
RECALL = 0.9995
SIGNATURE = 64
SMALL = 64
"""Sets of a bucket that is compared rather than split."""
DEPTH = 3
BLOCK = 256
"""Sets of one side of a comparison in a task; larger buckets and groups are compared block by block."""
SLACK = 0.25
"""How far the share of equal coordinates may lie below the similarity: five standard deviations of a signature's error."""
WORDS_KEPT = 500_000
COLUMNS = 4_096  # shingles that a comparison holds at once

U64 = np.uint64


class _Hashes(dict):
    """Hashes of words that a task remembers; it forgets all of them when there are more than WORDS_KEPT."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)  # the finaliser of splitmix64
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingler(width: int = WIDTH) -> Callable[[str | None], np.ndarray]:
    """A function from a text to the sorted hashes of its shingles."""
    hashed = _Hashes()
    factors = _mixed(np.arange(1, width + 1, dtype=U64)) | U64(1)

    def shingles(text: str | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.zeros(0, U64)
        h = np.fromiter(map(hashed.__getitem__, words), U64, len(words))
        n = max(1, len(h) - width + 1)
        total = np.full(n, len(words) if len(words) < width else width, U64)
        for k in range(min(width, len(h))):
            total += _mixed(h[k : k + n] * factors[k])
        return np.unique(_mixed(total))

    return shingles


def signature(shingles: np.ndarray, seeds: np.ndarray) -> bytes:
    """Least hash of the set under each seed, 32 bits of it."""
    out = np.empty(len(seeds), np.uint32)
    for i, seed in enumerate(seeds):
        out[i] = ((shingles ^ seed) * U64(0x9E3779B97F4A7C15) >> U64(32)).min()
    return out.tobytes()


def text_key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), 1) - 2**63


def described(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, text_hash, text_key (null for no text), set_key (null without words) and signature of each row.

    text_hash and text_key tell texts apart: one is Spark's own hash, which finds the rows of `df` again.
    """

    def make() -> Callable:
        shingles = shingler()
        seeds = _mixed(np.arange(1, SIGNATURE + 1, dtype=U64))

        def columns(texts: list[str | None]) -> list:
            texts_out, sets, signatures = [], [], []
            for t in texts:
                s = shingles(t)
                texts_out.append(None if t is None else text_key(t))
                sets.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 if len(s) else None)
                signatures.append(signature(s, seeds) if len(s) else None)
            return [texts_out, sets, signatures]

        return columns

    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return add_columns(rows, ["text"], "text_key long, set_key long, signature binary", make).drop("text")


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """Runs after which a pair at the threshold is missed with a probability of at most 1 - recall.

    The children that a pair shares number about Poisson with mean 1 at each level, so it survives a level with
    probability 1 - exp(-s), s being its chance to survive the levels below.
    """
    survives = 1.0
    for _ in range(depth):
        survives = 1 - math.exp(-survives)
    return math.ceil(math.log(1 - recall) / math.log(1 - survives))


def _picks(path: Column, similarity: float) -> Column:
    """The coordinates that the bucket of this path picks, 1 / similarity on average."""
    return F.filter(
        F.sequence(F.lit(0), F.lit(SIGNATURE - 1)),
        lambda i: F.shiftrightunsigned(F.xxhash64(path, i), 12) < int(2**52 / (similarity * SIGNATURE)),
    )


def _child(path: Column, i: Column) -> Column:
    return F.xxhash64(path, i, F.substring("signature", i * 4 + 1, F.lit(4))).alias("path")


def _first_level(sets: DataFrame, similarity: float, runs: int) -> DataFrame:
    """Every set in the children of the first bucket of each run; these buckets' picks are known before any set is read."""
    paths = sets.sparkSession.range(runs).select(F.xxhash64(F.lit("run"), "id").alias("path"))
    picks = paths.select("path", F.explode(_picks(F.col("path"), similarity)).alias("i")).collect()
    pairs = F.array(*(F.struct(F.lit(p.path).alias("path"), F.lit(p.i).alias("i")) for p in picks))
    spread = sets.withColumn("p", F.explode(pairs))
    return spread.select(_child(F.col("p.path"), F.col("p.i")), "set_key")


def buckets(sets: DataFrame, similarity: float, recall: float) -> DataFrame:
    """path, set_key, signature and size of the leaves of all runs that hold two sets or more."""
    level = settled(_first_level(sets, similarity, runs_for(recall, similarity, DEPTH)))
    leaves = None
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        # Signatures follow only to the sets that meet another.
        met = level.join(sizes, "path").join(sets, "set_key").select("path", "set_key", "signature", "size")
        if depth == DEPTH:
            return leaves.unionByName(met)
        leaf = met.where(F.col("size") <= SMALL)
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        spread = met.where(F.col("size") > SMALL).withColumn("i", F.explode(_picks(F.col("path"), similarity)))
        level = settled(spread.select(_child(F.col("path"), F.col("i")), "set_key"))


def in_blocks(rows: DataFrame, group: str, member: str, size: str) -> DataFrame:
    """Rows copied to the pairs of blocks that make up all pairs of a group: columns cell and side (0, 1) are added.

    Groups of up to BLOCK members are one cell and not copied.
    """
    blocks = F.ceil(F.col(size) / float(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit("block")), F.col("blocks")).cast("int")
    placed = rows.withColumn("blocks", blocks).withColumn("own", own)
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return spread.select(
        *(c for c in rows.columns), F.xxhash64(group, low, high).alias("cell"), (F.col("own") != low).cast("int").alias("side")
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell, from batches that are sorted by cell."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cells = batch.column("cell").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(cells[1:] != cells[:-1]) + 1
        if held and len(cells) and held[-1].column("cell")[-1].as_py() != cells[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts:
            yield pa.Table.from_batches([*held, batch.slice(start, cut - start)])
            held, start = [], cut
        if batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _labels(similar: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix, the first row of its component."""
    label = np.full(len(similar), -1)
    for start in range(len(similar)):
        if label[start] >= 0:
            continue
        label[start] = start
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(similar[front].any(0) & (label < 0))
            label[front] = start
    return label


def tree(keys: np.ndarray, similar: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the symmetric matrix `similar` connects.

    Two blocks' own cells connect what belongs together in each block; their common cell only adds what joins the two.
    """
    if not side.any():
        label = _labels(similar)
        a = np.flatnonzero(label != np.arange(len(label)))
        return keys[a], keys[label[a]]
    same = side[:, None] == side[None, :]
    label = _labels(similar & same)
    roots, at = np.unique(label, return_inverse=True)
    joined = np.zeros((len(roots), len(roots)), bool)
    i, j = np.nonzero(similar & ~same)
    joined[at[i], at[j]] = True
    over = _labels(joined)
    a = np.flatnonzero(over != np.arange(len(over)))
    return keys[roots[a]], keys[roots[over[a]]]


def _signature_edges(least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if group.num_rows < 2:
                continue
            keys = group.column("set_key").to_numpy()
            raw = b"".join(group.column("signature").to_pylist())
            rows = np.frombuffer(raw, np.uint32).reshape(len(keys), SIGNATURE)
            side = group.column("side").to_numpy()
            similar = np.zeros((len(keys), len(keys)), bool)
            for i in range(len(keys) - 1):
                similar[i, i + 1 :] = (rows[i + 1 :] == rows[i]).sum(1) >= least
            a, b = tree(keys, similar | similar.T, side)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the shingles that two sets or more have, some columns at a time."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[column] > 1
    owner, column = owner[keep], (np.cumsum(count > 1) - 1)[column[keep]]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    out = np.zeros((n, n))
    for start in range(0, int((count > 1).sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = 1
        out += part @ part.T
    return out


def _exact_links(similarity: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            keys = group.column("set_key").to_numpy()
            if len(keys) < 2:
                continue
            sets = [np.frombuffer(x, U64) for x in group.column("shingles").to_pylist()]
            texts, side = group.column("texts").to_numpy(), group.column("side").to_numpy()
            size = np.array([len(s) for s in sets])
            common = _overlaps(sets)
            # Without rounding: common / union >= similarity, for thresholds of up to three decimals.
            similar = 1000 * common >= round(1000 * similarity) * (size[:, None] + size[None, :] - common)
            np.fill_diagonal(similar, False)
            a, b = tree(keys, similar, side)
            # Pairs of one block are counted in that block's own cell.
            if side.any():
                similar &= side[:, None] != side[None, :]
            links = (similar * texts[None, :]).sum(1)
            linked = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([a, keys[linked]])),
                    pa.array([*b.tolist(), *[None] * len(linked)], pa.int64()),
                    pa.array([*[0] * len(a), *links[linked].tolist()], pa.int64()),
                ],
                ["a", "b", "links"],
            )

    return run


def _classes(df: DataFrame, key: str, text: str, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """The described rows; and for each text its class (`worded` and `root`), class_id, n_links and n_copies."""
    rows = settled(described(df, key, text))
    texts = rows.where("set_key IS NOT NULL").groupBy("set_key", "text_key").agg(F.first("signature").alias("signature"))
    sets = settled(texts.groupBy("set_key").agg(F.first("signature").alias("signature"), F.count(F.lit(1)).alias("texts")))
    met = in_blocks(buckets(sets.select("set_key", "signature"), similarity, recall), "path", "set_key", "size")
    dealt = met.repartition("cell").sortWithinPartitions("cell")
    least = math.ceil((similarity - SLACK) * SIGNATURE)
    maybe = components(dealt.mapInArrow(_signature_edges(least), "a long, b long"))

    # The shingles of the sets that may have a link, from one text of each set.
    groups = maybe.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    grouped = maybe.withColumnRenamed("node", "set_key").join(groups, "root").join(sets.drop("signature"), "set_key")
    keyed = rows.where("set_key IS NOT NULL AND key IS NOT NULL")
    one_of = keyed.groupBy("set_key").agg(F.min(F.struct("key", "text_key")).alias("one"))
    wanted = one_of.join(grouped, "set_key").select("set_key", "root", "size", "texts", "one.*")
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def make() -> Callable:
        shingles = shingler()
        return lambda ts: [[shingles(t).tobytes() for t in ts], [text_key(t or "") for t in ts]]

    chosen = source.join(wanted.select("key").distinct(), "key", "left_semi")
    read = add_columns(chosen, ["text"], "shingles binary, text_key long", make)
    read = read.groupBy("key", "text_key").agg(F.first("shingles").alias("shingles"))
    compared = in_blocks(
        wanted.join(read, ["key", "text_key"]).select("root", "set_key", "size", "texts", "shingles"), "root", "set_key", "size"
    )
    dealt = compared.repartition("cell").sortWithinPartitions("cell")
    found = settled(dealt.mapInArrow(_exact_links(similarity), "a long, b long, links long"))
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "set_key")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("links"))

    # One row for each text, then for each set and class.
    by_text = rows.groupBy("set_key", "text_key").agg(F.count(F.lit(1)).alias("n_copies"), F.min("key").alias("least"))
    by_set = (
        by_text.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("least").alias("least"))
        .join(roots, "set_key", "left")
        .join(links, "set_key", "left")
        .withColumn("root", F.coalesce("root", "set_key"))
    )
    classes = by_set.groupBy("root").agg(F.min("least").alias("class_id"))
    known = by_set.join(classes, "root").select(
        "set_key", "root", "class_id", (F.col("texts") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    columns = ["text_key", "worded", "root", "class_id", "n_links", "n_copies"]
    wordless = by_text.where("set_key IS NULL AND text_key IS NOT NULL").select(
        "text_key",
        F.lit(False).alias("worded"),
        F.col("text_key").alias("root"),
        F.col("least").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        "n_copies",
    )
    worded = by_text.where("set_key IS NOT NULL").join(known, "set_key").withColumn("worded", F.lit(True)).select(*columns)
    return rows, worded.unionByName(wordless)


def near_copies(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """key, class_id, n_links and n_copies of each row.

    class_id: the least key of the texts connected by links. n_links: other texts of a similarity of at least `similarity`,
    equal texts counting once. n_copies: rows with this text. Rows with a null key take no part in classes of others and
    have a null class.
    """
    rows, by_text = _classes(df, key, text, similarity, recall)
    counts = [F.col(name).cast("long").alias(name) for name in ("n_links", "n_copies")]
    # Null texts stay out of the join, where they would be one key.
    met = rows.where("text_key IS NOT NULL").join(by_text, "text_key").select("key", "class_id", *counts)
    null = rows.where("text_key IS NULL").select(
        "key", F.col("key").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies")
    )
    return met.unionByName(null).select(
        F.col("key").alias(key),
        F.when(F.col("key").isNotNull(), F.coalesce("class_id", "key")).alias("class_id"),
        "n_links",
        "n_copies",
    )


def first_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` without near copies: one row of each class stays, that with the least key.

    Of different texts that share that key, that with the least hash stays; of rows equal in key and text, the one whose other
    columns have the least hash. A null text is near to nothing, but rows equal in key with null texts are one. Rows with
    a null key stay.
    """
    rows, by_text = _classes(df.where(F.col(key).isNotNull()), key, text, SIMILARITY, RECALL)
    first = F.min(F.struct("key", "text_hash")).alias("one")
    classes = rows.where("text_key IS NOT NULL").join(by_text.select("text_key", "worded", "root"), "text_key")
    kept = classes.groupBy("worded", "root").agg(first).select("one.key", "one.text_hash").withColumn("null", F.lit(False))
    null = rows.where("text_key IS NULL").select("key", "text_hash", F.lit(True).alias("null")).distinct()
    group = ["key", "text_hash", "null"]
    counted = rows.groupBy("key", "text_hash", F.col("text_key").isNull().alias("null")).agg(F.count(F.lit(1)).alias("n"))
    stay = settled(counted.join(kept.unionByName(null), group, "left_semi"))
    own = [F.col(key), F.xxhash64(text), F.col(text).isNull()]

    def of(some: DataFrame) -> DataFrame:
        """The rows of `df` whose key and text are among some."""
        named = some.select(*(F.col(name).alias(f"_stay_{name}") for name in group))
        same = [mine == F.col(f"_stay_{name}") for mine, name in zip(own, group, strict=True)]
        return df.join(named, same, "left_semi")

    # Only rows that are repeated are compared whole; equal ones meet in their tasks before they are shuffled.
    hashed = [field.name for field in df.schema if not isinstance(field.dataType, T.MapType)]
    first_row = F.min_by(F.struct(*df.columns), F.xxhash64(*hashed)).alias("_row")
    repeated = of(stay.where("n > 1")).groupBy(*(c.alias(f"_stay_{n}") for c, n in zip(own, group))).agg(first_row).select("_row.*")
    return of(stay.where("n = 1")).unionByName(repeated).unionByName(df.where(F.col(key).isNull()))
