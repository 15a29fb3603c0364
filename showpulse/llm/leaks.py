"""Benchmark items in training texts: rare word n-grams as seeds, then alignment.

Every run of SEED words of an item is a seed. One pass over the texts keeps, for each text that holds seeds, the passages
around them, as numbers of the items' words. In how many texts a seed occurs tells how rare it is; a passage is joined to an
item if the rarity of the seeds they share adds up to RARITY, which one rare seed does, or several commoner ones. Such a
passage and item are aligned word by word (Smith-Waterman), which copes with words exchanged, added or left out. The
alignment's share of the item's perfect score decides.

Texts: words are runs of letters and digits in lower case. Null and empty texts hold nothing; neither do null items and
items of fewer than SEED words, which have no seed. Long texts are searched whole. Repeated rows and items with equal texts are
reported each, repeated items once; items with a null key are left out. Columns other than keys and texts play no part. An empty table on either side gives an empty table.
"""

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from showpulse.sources.shared import settled

SEED = 3
RARITY = 6.0
"""Least sum of ln(texts / texts with the seed); a seed in one of 400 texts has 6."""
SHARE = 0.45
"""Least share of the perfect score; a copy with a fifth of its words exchanged has 0.7."""
ITEM_WORDS = 100_000
"""Words of the items that are searched for in one pass; more items take more passes."""

WORDS = re.compile(r"\w+").findall
MATCH, MISMATCH, GAP = 2, -1, -1  # scores of the alignment


def words(text: str | None) -> list[str]:
    return WORDS(text.lower()) if text else []


class Items:
    """A bounded block of items: their words by number, and their seeds."""

    def __init__(self, rows: list[tuple]) -> None:
        self.number: dict[str, int] = {}
        self.keys, self.texts = [], []
        for key, text in sorted(rows, key=lambda r: (str(r[0]), r[1])):
            found = words(text)
            if len(found) >= SEED:
                self.keys.append(key)
                self.texts.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in found]))
        self.base = len(self.number) + 1
        self.longest = max((len(t) for t in self.texts), default=0)
        codes = [self.seeds(t) for t in self.texts]
        self.codes = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
        self.items_of: dict[int, list[int]] = defaultdict(list)
        for item, own in enumerate(codes):
            for code in np.unique(own).tolist():
                self.items_of[code].append(item)

    def seeds(self, numbers: np.ndarray) -> np.ndarray:
        """The number of each run of SEED words; 0 where one of them is in no item."""
        n = len(numbers) - SEED + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        made, whole = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(SEED):
            made = made * self.base + numbers[k : k + n]
            whole &= numbers[k : k + n] > 0
        return np.where(whole, made, 0)

    def passages(self, text: str | None) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """First word, word numbers and seeds of the stretches that reach an item's length around each seed."""
        get = self.number.get
        numbers = np.array([get(w, 0) for w in words(text)], np.int64)
        codes = self.seeds(numbers)
        spots = np.flatnonzero(codes)
        if len(spots):
            at = np.minimum(np.searchsorted(self.codes, codes[spots]), len(self.codes) - 1)
            spots = spots[self.codes[at] == codes[spots]]
        if not len(spots):
            return []
        cuts = np.flatnonzero(np.diff(spots) > 2 * self.longest) + 1
        made = []
        for part in np.split(spots, cuts):
            first = max(0, int(part[0]) - self.longest)
            made.append((first, numbers[first : int(part[-1]) + SEED + self.longest], np.unique(codes[part])))
        return made


def aligned(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best score of a local alignment, and the place in the passage where it ends."""
    place = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        fresh = np.maximum(row + GAP, 0)
        fresh[1:] = np.maximum(fresh[1:], row[:-1] + step)
        fresh[0] = 0
        # Gaps in the item: the best of all earlier places less the distance.
        row = np.maximum.accumulate(fresh + place) - place
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[Items]:
    """Blocks of at most about twice ITEM_WORDS words; single items longer than that are blocks of their own."""
    rows = items.select(F.col(key).alias("key"), F.col(text).alias("text")).dropna().distinct()
    sized = rows.withColumn("n", F.regexp_count("text", F.lit(r"\w+")))
    total = sized.agg(F.sum("n")).first()[0] or 0
    count = max(1, -(-total // ITEM_WORDS))
    while True:
        block = F.pmod(F.xxhash64("key", "text"), F.lit(count))
        largest = sized.groupBy(block.alias("b")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"))
        if not largest.where((F.col("n") > 2 * ITEM_WORDS) & (F.col("items") > 1)).take(1):
            break
        count *= 2
    for b in range(count):
        found = Items([tuple(r) for r in rows.where(block == b).collect()])
        if found.keys:
            yield found


def leaks(texts: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """key, item, share and end of each text and item whose alignment reaches SHARE of the item's perfect score.

    `end`: the number of words up to the alignment's last word. A text that holds an item several times is reported with
    the best of them, of equals the first.
    """
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    n = texts.count()
    kind, item_kind = texts.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"key {kind}, row long, item {item_kind}, share double, end int"
    found = None
    for block in _blocks(items, item, text):
        part = _in_block(rows, block, n, kind, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = texts.sparkSession.createDataFrame([], schema)
    best = found.groupBy("key", "row", "item").agg(F.min(F.struct((-F.col("share")).alias("s"), "end")).alias("b"))
    return best.select(F.col("key").alias(key), F.col("item").alias(item), (-F.col("b.s")).alias("share"), "b.end")


def _in_block(rows: DataFrame, block: Items, n: int, kind: str, schema: str) -> DataFrame:
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(block)
    names = ["key", "row", "start", "numbers", "seeds"]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            keys, ids = batch.column(0), batch.column(2).to_pylist()
            for start in range(0, batch.num_rows, 512):
                made = [
                    (start + i, ids[start + i], first, numbers.astype(np.int32), codes)
                    for i, t in enumerate(batch.column(1).slice(start, 512).to_pylist())
                    for first, numbers, codes in items.passages(t)
                ]
                if made:
                    places, row, first, numbers, codes = zip(*made, strict=True)
                    columns = [keys.take(pa.array(places)), pa.array(row, pa.int64()), pa.array(first, pa.int32())]
                    columns += [pa.array(list(numbers), pa.list_(pa.int32())), pa.array(list(codes), pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names)

    passages = settled(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            keep, f"key {kind}, row long, start int, numbers array<int>, seeds array<long>"
        )
    )
    # As many rows as the block has seeds at most.
    seeds = passages.select("row", F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count_distinct("row").alias("texts"))
    table = seeds.toArrow()
    rarity = dict(zip(table.column("seed").to_pylist(), [math.log(n / t) for t in table.column("texts").to_pylist()], strict=True))
    known = spark.sparkContext.broadcast(rarity)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value, known.value
        for batch in batches:
            made = []
            numbers, starts = batch.column(3), batch.column(2).to_pylist()
            for i, codes in enumerate(batch.column(4).to_pylist()):
                shared_rarity: dict[int, float] = defaultdict(float)
                for code in codes:
                    for which in items.items_of[code]:
                        shared_rarity[which] += weights[code]
                passage = None
                for which, rare in shared_rarity.items():
                    own = items.texts[which]
                    # A seed that all texts share has no rarity; an item that is in most texts is told by many of them.
                    if rare >= RARITY or _most(items, own, codes):
                        passage = np.asarray(numbers[i].values) if passage is None else passage
                        score, end = aligned(own, passage)
                        share = score / (MATCH * len(own))
                        if share >= SHARE:
                            made.append((i, which, share, starts[i] + end))
            if made:
                places, which, share, end = zip(*made, strict=True)
                keys, row = batch.column(0).take(pa.array(places)), batch.column(1).take(pa.array(places))
                held = pa.array([items.keys[w] for w in which]).cast(item_type)
                columns = [keys, row, held, pa.array(share, pa.float64()), pa.array(end, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "row", "item", "share", "end"])

    item_type = to_arrow_schema(T.StructType.fromDDL(schema)).field("item").type
    return passages.mapInArrow(align, schema)


def _most(items: Items, own: np.ndarray, codes: list[int]) -> bool:
    """Whether a passage holds at least a third of an item's seeds."""
    wanted = np.unique(items.seeds(own))
    return 3 * len(np.intersect1d(wanted, np.array(codes))) >= len(wanted)


def without_leaks(texts: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of `texts` whose key is that of no text with a leak; rows with a null key stay."""
    bad = leaks(texts, items, key, item, text).select(F.col(key)).distinct()
    return texts.join(bad, key, "left_anti").select(*texts.columns)

