"""Vector bin packing of examples into training sequences with limits on tokens, segments and loss-bearing tokens.

An example demands tokens, one segment, and the tokens that bear loss. One sequence is open at a time; of the examples that
fit, it takes the one with the greatest dot product of its demand and what the sequence has left, both as shares of the
limits. So what a sequence has most of is asked for most. Examples wait in a pool; when none fits whole, the one with
the greatest product is cut so that it fills the sequence. What stays below the limits at the end of a partition, or for
want of segments, is cut into sequences whose lengths are powers of two, which need no padding.

Each partition is packed where it lies, without a shuffle, in one pass: a task holds the pool and no more than one example
besides. Numbers of sequences begin with the partition's; a table's files are always read in the same partitions and order,
so a repeated task gives the same pieces.

Examples without ids (null or empty) are in no sequence and have no row. Repeated rows are packed each. Of equal products the
example that came first is taken. Long examples give full sequences first, and only their rest waits. Columns of the input
named like an output are replaced. An empty table gives an empty table.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

POOL_TOKENS = 64
"""Sequences' worth of tokens that wait in the pool before one is filled."""
POOL_EXAMPLES = 1_024
"""The most examples that wait; a sequence is filled when there are more."""
ROWS = 256
"""Rows that are read, and pieces that are given out, at once."""
WIDTH = 4  # bytes of an id


class Limits(NamedTuple):
    """What a sequence may hold at most."""

    tokens: int = 4_096
    segments: int = 256
    loss: int = 4_096


class Example(NamedTuple):
    """What is left of an example: its other columns, ids, which of them bear loss, and the ids before it."""

    row: tuple
    ids: memoryview
    loss: np.ndarray  # running count of loss-bearing ids, from 0
    start: int
    whole: int


class Pool:
    """Examples that wait, with their demands in arrays."""

    def __init__(self, limits: Limits) -> None:
        self.limits = np.array(limits, np.float64)
        self.examples: list[Example | None] = []
        self.demand = np.zeros((2 * POOL_EXAMPLES, 3))
        self.tokens = self.count = 0

    def add(self, example: Example) -> None:
        if len(self.examples) == len(self.demand):
            kept = [i for i, e in enumerate(self.examples) if e is not None]
            self.demand[: len(kept)] = self.demand[kept]
            self.examples = [self.examples[i] for i in kept]
        self.examples.append(example)
        self.demand[len(self.examples) - 1] = demand(example)
        self.tokens += tokens(example)
        self.count += 1

    def take(self, left: np.ndarray, fits: bool) -> Example | None:
        """The example with the greatest dot product with `left`; with `fits`, of those that are within it."""
        asked = self.demand[: len(self.examples)]
        score = asked @ (left / self.limits**2)
        able = asked[:, 0] > 0
        if fits:
            able &= (asked <= left).all(1)
        if not able.any():
            return None
        i = int(np.argmax(np.where(able, score, -1.0)))
        example, self.examples[i] = self.examples[i], None
        self.demand[i] = 0
        self.tokens -= tokens(example)
        self.count -= 1
        return example


def tokens(example: Example) -> int:
    return len(example.ids) // WIDTH


def demand(example: Example) -> tuple[int, int, int]:
    return tokens(example), 1, int(example.loss[-1] - example.loss[0])


def divided(example: Example, n: int) -> tuple[Example, Example | None]:
    """The first `n` ids of an example, and the rest if there is any."""
    head = example._replace(ids=example.ids[: n * WIDTH], loss=example.loss[: n + 1])
    if n >= tokens(example):
        return head, None
    return head, example._replace(ids=example.ids[n * WIDTH :], loss=example.loss[n:], start=example.start + n)


def prefix_within(example: Example, left: np.ndarray) -> int:
    """How many first ids of an example are within what is left."""
    by_loss = int(np.searchsorted(example.loss, example.loss[0] + left[2], "right")) - 1
    return min(int(left[0]), by_loss, tokens(example))


def powers_of_two(pieces: list[Example]) -> Iterator[list[Example]]:
    """The pieces of one sequence as sequences whose lengths are powers of two, the longest first."""
    left = sum(map(tokens, pieces))
    waiting = list(reversed(pieces))
    while left:
        room = size = 1 << (left.bit_length() - 1)
        sequence = []
        while room:
            head, rest = divided(waiting.pop(), room)
            sequence.append(head)
            room -= tokens(head)
            if rest is not None:
                waiting.append(rest)
        yield sequence
        left -= size


def sequences(examples: Iterator[Example], limits: Limits, whole: bool = False) -> Iterator[list[Example]]:
    """Sequences of pieces. With `whole`, only examples beyond a limit are cut, and short sequences stay as they are."""
    pool = Pool(limits)
    full = np.array(limits, np.float64)

    def fill() -> Iterator[list[Example]]:
        left, sequence = full.copy(), []
        while left[0] >= 1 and left[1] >= 1:
            example = pool.take(left, fits=True)
            if example is None and not whole and (cut := pool.take(left, fits=False)) is not None:
                n = prefix_within(cut, left)
                example, rest = divided(cut, n) if n else (None, cut)
                if rest is not None:
                    pool.add(rest)
            if example is None:
                break
            sequence.append(example)
            left -= demand(example)
        if whole or left[0] == 0:
            yield sequence
        else:
            yield from powers_of_two(sequence)

    for example in examples:
        while example is not None and any(d > limit for d, limit in zip(demand(example), limits)):
            head, example = divided(example, max(1, prefix_within(example, full)))
            if tokens(head) == limits.tokens:
                yield [head]
            else:
                pool.add(head)
        if example is not None:
            pool.add(example)
        while pool.count >= POOL_EXAMPLES or pool.tokens >= POOL_TOKENS * limits.tokens:
            yield from fill()
    while pool.count:
        yield from fill()


def packed(
    df: DataFrame, limits: Limits = Limits(), ids: str = "ids", loss: str | None = None, whole: bool = False
) -> DataFrame:
    """One row for each piece of an example: the other columns of `df`, the piece's `ids`, and where it is.

    `ids` holds little-endian 32-bit ids; `loss`, if named, a byte for each id that is not 0 where the id bears loss (without
    it, or where it is null, all do). Added: `start` and `length` in the example, whose ids number `example_tokens`;
    `sequence_id` and `offset`, the place in the sequence.
    """
    if min(limits) < 1:
        raise ValueError("limits must be positive")
    added = T.StructType.fromDDL("start long, length long, example_tokens long, sequence_id long, offset long, ids binary")
    outputs = {field.name.lower() for field in added} | {name.lower() for name in (ids, loss) if name}
    kept = [i for i, field in enumerate(df.schema) if field.name.lower() not in outputs]
    ids_at, loss_at = df.columns.index(ids), df.columns.index(loss) if loss else None
    schema = T.StructType([*(df.schema[i] for i in kept), *added])
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Example]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                rows = list(zip(*(part.column(i).to_pylist() for i in kept), strict=True)) or [()] * part.num_rows
                masks = part.column(loss_at) if loss_at is not None else [None] * part.num_rows
                for row, value, mask in zip(rows, part.column(ids_at), masks, strict=True):
                    if value.is_valid and (held := memoryview(value.as_buffer())):
                        n = len(held) // WIDTH
                        bears = np.ones(n, np.int64)
                        if mask is not None and mask.is_valid:
                            bears = (np.frombuffer(mask.as_buffer(), np.uint8) != 0).astype(np.int64)
                            if len(bears) != n:
                                raise ValueError(f"{loss} has {len(bears)} bytes for {n} ids")
                        # Own copies: a waiting example must not hold the batch that it came with.
                        yield Example(row, memoryview(bytes(held)), np.append(0, np.cumsum(bears)), 0, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        for number, sequence in enumerate(sequences(read(batches), limits, whole)):
            offset = 0
            for e in sequence:
                out.append((*e.row, e.start, tokens(e), e.whole, first + number, offset, bytes(e.ids)))
                offset += tokens(e)
            if len(out) >= ROWS:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    return df.mapInArrow(run, schema)
