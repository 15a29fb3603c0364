"""Prefix trie of conversations by a skeleton of range splitters.

Every conversation becomes a path: for each turn 20 bytes, a digest of role and text and the number of words of the text.
Paths in byte order, copies by conversation, are cut into shards at splitters drawn from a sample. A node of the trie, that is
a prefix of paths, lies in one shard unless it is a prefix of a splitter. The trie of all splitters, the skeleton, is broadcast;
each shard finishes its other nodes alone and gives partial aggregates of the skeleton's, which are then added up.

A task holds one shard, of about TURNS turns: more only where one conversation is longer, where paths agree in the DEPTH
first turns that splitters look at, or where a table would need more than SHARDS shards. The skeleton has at most SHARDS *
DEPTH nodes. The conversations that end at a node are hashed in the order of their numbers: shards give those of the
skeleton as stretches of text, and one task puts a node's stretches into its hash as they come, holding one at a time.

Rows: those without a conversation take no part. Null roles and texts are empty. Turns of a conversation are in the order of
`turn`, null first; turns of equal number are in the order of their role and text, so repeated rows are repeated turns. Digests
have 128 bits; different turns are taken to have different ones. A very long conversation is one path, 20 bytes a turn; its
texts are never together. Other columns play no part. A table without conversations gives no row.
"""

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from showpulse.sources.shared import settled, shared_folder

TURNS = 20_000
"""Turns of a shard, about."""
SHARDS = 65_536
"""The most shards."""
DEPTH = 32
"""Turns of a path that splitters look at."""
DRAWN = 6
"""Paths drawn for each shard, about, to choose splitters from: at most SHARDS * DRAWN * DEPTH * STEP bytes on the driver."""
STRETCH = 4_096
"""Numbers of conversations in one stretch of text, and rows given out at once."""
FEW = 1 << 20
"""The most conversations whose numbers are broadcast."""

STEP = 20  # bytes of a turn in a path: 16 of its digest, 4 of its number of words
FIRST = np.iinfo(np.int64).min
NODES = T.StructType(
    [
        T.StructField("skeleton", T.IntegerType()),
        *(
            T.StructField(name, T.LongType())
            for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
        ),
    ]
)
PARTS = T.StructType([T.StructField("kind", T.StringType()), *NODES, T.StructField("ends", T.StringType())])
ENDS = T.StructType([T.StructField("skeleton", T.IntegerType()), T.StructField("ends_sha256", T.StringType())])


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the turn's bytes in a path, of the rows that take part."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    code = F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(words(text).cast("long")), 8, "0")))
    return df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), code.alias("code")
    )


def own_paths(df: DataFrame) -> DataFrame:
    """conv_id and path of every conversation as it stands. Texts are shuffled only to order turns of equal number."""
    codes = turns(df)
    first = F.col("turn").asc_nulls_first()
    found = settled(_gathered(codes, [first, "code"]))
    tied = found.where("tied").select("conv_id")
    if not (n := tied.count()):
        return found.select("conv_id", "path")
    again = codes.join(F.broadcast(tied) if n <= FEW else tied, "conv_id", "left_semi")
    ordered = _gathered(again, [first, "role", "text"])
    return found.where("NOT tied").unionByName(ordered).select("conv_id", "path")


def _gathered(codes: DataFrame, order: list) -> DataFrame:
    """conv_id, path and whether turns of equal number differ: rows in order, put together as they pass."""
    rows = codes.repartition("conv_id").sortWithinPartitions("conv_id", *order).select("conv_id", "turn", "code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turn, path, tied = None, None, bytearray(), False
        done: list[tuple] = []
        for batch in batches:
            for c, t, code in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if c != conv:
                    if conv is not None:
                        done.append((conv, bytes(path), tied))
                    conv, path, tied = c, bytearray(), False
                elif t == turn and code != path[-STEP:]:
                    tied = True
                turn = t
                path += code
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names)
                done = []
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (conv, bytes(path), tied)], names)

    names = ["conv_id", "path", "tied"]
    return rows.mapInArrow(run, "conv_id long, path binary, tied boolean")


def rebuilt_paths(df: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """conv_id and path of every conversation c after it was given the first h turns of conversation c - c % `family` in place
    of its own first h; h is the crc32 of c's number as text, modulo `shared`.
    """
    own = settled(own_paths(df))
    heads = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head"), F.substring("path", 1, STEP * (shared - 1)).alias("given")
    )
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared * STEP
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % family == F.col("head"), "left").withColumn(
        "taken", taken.cast("int")
    )
    given = F.coalesce(F.substr("given", F.lit(1), F.col("taken")), F.lit(b""))
    return joined.select("conv_id", F.concat(given, F.substr("path", F.col("taken") + 1)).alias("path"))


class Skeleton:
    """The trie of the splitters' prefixes. Node 0 is the root; a node's number is above its parent's."""

    def __init__(self, splitters: list[tuple[bytes, int]]) -> None:
        self.splitters = splitters
        self.parent, self.words, self.depth = [-1], [0], [0]
        self.children: list[dict[bytes, int]] = [{}]
        for path, conv in splitters:
            node = 0
            # All paths that begin with a whole splitter are behind it, unless it also names a conversation.
            for at in range(0, len(path) if conv > FIRST else len(path) - STEP, STEP):
                code = path[at : at + STEP]
                if (child := self.children[node].get(code)) is None:
                    self.children[node][code] = child = len(self.parent)
                    self.children.append({})
                    self.parent.append(node)
                    self.words.append(int.from_bytes(code[16:]))
                    self.depth.append(self.depth[node] + 1)
                node = child

    def finished(self, partial: dict[int, tuple[int, int, int, int, int]]) -> list[tuple]:
        """NODES from the sums of n_convs, n_children, n_leaves and saved_tokens, and the least conv_id, of each node."""
        size = len(self.parent)
        leaves, saved = [0] * size, [0] * size
        for i in range(size - 1, -1, -1):
            n, children, below, spared, _ = partial[i]
            leaves[i] += below + (not children and not self.children[i])
            saved[i] += spared + (n - 1) * self.words[i]
            if i:
                # Only what this node and skeleton nodes below it add: shards have counted their own nodes for every ancestor.
                leaves[self.parent[i]] += leaves[i] - below
                saved[self.parent[i]] += saved[i] - spared
        rows = []
        for i in range(size):
            n, children, _, _, least = partial[i]
            above = partial[self.parent[i]][4] if i else None
            rows.append((i, least, self.depth[i], above, n, children + len(self.children[i]), leaves[i], saved[i]))
        return rows


def agreed(a: bytes, b: bytes) -> int:
    """How many first turns two paths share."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // STEP
    at = 0
    while a[at : at + STEP] == b[at : at + STEP]:
        at += STEP
    return at // STEP


def splitters(drawn: list[tuple[bytes, int, int]], shards: int) -> list[tuple[bytes, int]]:
    """At most `shards` - 1 keys that cut (path, conversation) into parts of equal weight; drawn: path, conversation, weight.

    A key is no longer than it must be to tell its path from the one drawn before it.
    """
    drawn = sorted(drawn)
    total, reached, keys = sum(w for _, _, w in drawn), 0, []
    for before, (path, conv, weight) in zip([None, *drawn], drawn):
        if before is not None and reached * shards >= (len(keys) + 1) * total:
            same = agreed(before[0], path) * STEP
            keys.append((path, conv) if same == len(path) else (path[: same + STEP], FIRST))
        reached += weight
    return sorted(set(keys))


def shard_rows(skeleton: Skeleton, convs: list[int], found: list[bytes]) -> Iterator[tuple]:
    """PARTS of one shard, from its conversations and their paths in order."""
    parent, depth, known, weight, n, least, first = (array("q") for _ in range(7))

    def add(above: int, at: int, code: bytes, number: int) -> int:
        parent.append(above), depth.append(at), known.append(number), weight.append(int.from_bytes(code[16:]))
        n.append(0), least.append(0), first.append(-1)
        return len(parent) - 1

    way = [add(-1, 0, b"", 0)]
    previous = b""
    for i, path in enumerate(found):
        del way[agreed(previous, path) + 1 :]
        for at in range((len(way) - 1) * STEP, len(path), STEP):
            code, above = path[at : at + STEP], known[way[-1]]
            number = skeleton.children[above].get(code, -1) if above >= 0 else -1
            way.append(add(way[-1], len(way), code, number))
        end = way[-1]
        if first[end] < 0:
            first[end] = i
        n[end] += 1
        previous = path

    size = len(parent)
    ends = array("q", n)
    children, leaves, saved = (array("q", bytes(8 * size)) for _ in range(3))
    for i in range(size - 1, -1, -1):
        if ends[i]:
            least[i] = min(least[i], convs[first[i]]) if n[i] > ends[i] else convs[first[i]]
        if known[i] < 0:
            leaves[i] += not children[i]
            saved[i] += (n[i] - 1) * weight[i]
        if i:
            p = parent[i]
            least[p] = min(least[p], least[i]) if n[p] > ends[p] else least[i]
            n[p] += n[i]
            leaves[p] += leaves[i]
            saved[p] += saved[i]
            children[p] += known[i] < 0

    for i in range(size):
        members = convs[first[i] : first[i] + ends[i]]
        if known[i] >= 0:
            yield "part", known[i], least[i], None, None, n[i], children[i], leaves[i], saved[i], None
            for at in range(0, len(members), STRETCH):
                stretch = members[at : at + STRETCH]
                yield "ends", known[i], stretch[0], None, None, None, None, None, None, ",".join(map(str, stretch))
            continue
        p = parent[i]
        digest = hashlib.sha256(",".join(map(str, members)).encode()).hexdigest()
        above, node = (None, known[p]) if known[p] >= 0 else (least[p], None)
        yield "node", node, least[i], depth[i], above, n[i], children[i], leaves[i], saved[i], digest


def _batches(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    for row in rows:
        held.append(row)
        if len(held) == STRETCH:
            yield batch()
            held = []
    if held:
        yield batch()


def trie(paths: DataFrame, turns: int = TURNS) -> DataFrame:
    """One row per node of the trie of `paths` (conv_id, path): conv_id and parent_conv_id, the smallest members of the node and
    of its parent (null for the root); depth; n_convs, n_children, n_leaves, saved_tokens; ends_sha256.
    """
    spark = paths.sparkSession
    paths = settled(paths)
    weight = F.octet_length("path") / STEP + 1
    sizes = paths.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("turns")).first()
    shards = max(1, min(SHARDS, round((sizes.turns or 0) / turns)))
    share = min(1.0, DRAWN * shards / max(1, sizes.n))
    drawn = paths.where(F.shiftrightunsigned(F.xxhash64("conv_id", F.lit("drawn")), 12) < int(share * 2**52)).select(
        F.substring("path", 1, DEPTH * STEP).alias("path"), "conv_id", weight.cast("long").alias("weight")
    )
    keys = splitters([(bytes(r.path), r.conv_id, r.weight) for r in drawn.collect()], shards) if shards > 1 else []
    held = spark.sparkContext.broadcast(Skeleton(keys))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = held.value.splitters
        for batch in batches:
            convs, found = (column.to_pylist() for column in batch.columns)
            shard = [bisect_right(keys, (path, conv)) for path, conv in zip(found, convs, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], ["conv_id", "path", "shard"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, convs, found = None, [], []
            for batch in batches:
                for shard, path, conv in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    if shard != now:
                        if found:
                            yield from shard_rows(held.value, convs, found)
                        now, convs, found = shard, [], []
                    convs.append(conv)
                    # Copies share one path.
                    found.append(found[-1] if found and found[-1] == path else path)
            if found:
                yield from shard_rows(held.value, convs, found)

        return _batches(rows(), PARTS)

    dealt = paths.select("conv_id", "path").mapInArrow(deal, "conv_id long, path binary, shard int")
    ordered = dealt.repartitionById(len(keys) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    folder = shared_folder(spark)
    ordered.select("shard", "path", "conv_id").mapInArrow(build, PARTS).write.partitionBy("kind").parquet(folder)
    parts = spark.read.schema(PARTS).parquet(folder)

    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    sums = parts.where("kind = 'part'").groupBy("skeleton").agg(
        total("n_convs"), total("n_children"), total("n_leaves"), total("saved_tokens"), F.min("conv_id").alias("conv_id")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partial = {}
        for batch in batches:
            for number, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                partial[number] = tuple(row)
        yield from _batches(iter(held.value.finished(partial) if partial else []), NODES)

    def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now = digest = None
            for batch in batches:
                for node, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    if node != now:
                        if digest is not None:
                            yield now, digest.hexdigest()
                        now, digest = node, hashlib.sha256()
                    else:
                        digest.update(b",")
                    digest.update(text.encode())
            if digest is not None:
                yield now, digest.hexdigest()

        return _batches(rows(), ENDS)

    skeleton = settled(sums.repartition(1).mapInArrow(finish, NODES))  # at most SHARDS * DEPTH rows
    stretches = parts.where("kind = 'ends'").select("skeleton", "conv_id", "ends").repartition("skeleton")
    ends = stretches.sortWithinPartitions("skeleton", "conv_id").select("skeleton", "ends").mapInArrow(hash_ends, ENDS)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = skeleton.join(ends, "skeleton", "left").select(
        *columns[:-1], F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    )
    above = skeleton.select("skeleton", F.col("conv_id").alias("_above"))
    rest = parts.where("kind = 'node'").withColumnRenamed("ends", "ends_sha256").join(F.broadcast(above), "skeleton", "left")
    return top.unionByName(
        rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*columns)
    )


def prefix_trie(df: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """The trie of rebuilt conversations of a table with conv_id, turn, role and text."""
    return trie(rebuilt_paths(df, family, shared))
