"""Shrink each micro-batch before its shuffle: one row per key and slot (as long as the gap) in each Arrow batch.

This is the map-side half of the visit reduction in `operators.visits`. Whatever share of a micro-batch one key
holds, its state function receives a few rows per slot only.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showpulse.functions.durations import micros


def slot_rows(df: DataFrame, keys: list[str], ts: str, gap: str, order: list[str]) -> DataFrame:
    """The first event of each slot, by `ts` and `order`, with the slot's first and last time in microseconds (`_first`,
    `_last`) and the number of its events (`_events`).

    Events without a time belong to no visit and are left out, as time windows leave them out.
    """
    timed = df.where(F.col(ts).isNotNull()).select("*", F.unix_micros(F.col(ts).cast("timestamp")).alias("_first"))
    schema = T.StructType([*timed.schema, T.StructField("_last", T.LongType()), T.StructField("_events", T.LongType())])
    width = micros(gap)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _shrunk(batch, keys, order, width).to_batches()

    return timed.mapInArrow(run, schema)


def _shrunk(batch: pa.RecordBatch, keys: list[str], order: list[str], width: int) -> pa.Table:
    table = pa.Table.from_batches([batch])
    at = pa.compute.sort_indices(
        table.select(dict.fromkeys(["_first", *order])),
        sort_keys=[("_first", "ascending"), *((name, "ascending") for name in order if name != "_first")],
        null_placement="at_start",
    )
    ordered = table.select(dict.fromkeys(["_first", *keys])).take(at)
    slot = pa.array(np.floor_divide(ordered["_first"].to_numpy(), width))
    numbered = ordered.append_column("_slot", slot).append_column("_n", pa.array(np.arange(len(at))))
    groups = numbered.group_by([*keys, "_slot"]).aggregate([("_n", "min"), ("_first", "max"), ("_n", "count")])
    first_rows = table.take(at.take(groups["_n_min"]))
    return first_rows.append_column("_last", groups["_first_max"]).append_column("_events", groups["_n_count"])


def one_per_slot(gap: str) -> Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]:
    """A function from slot rows in order to one row per key and slot."""
    width = micros(gap)

    def shrink(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        key, slot = rows["key"], rows["_first"] // width
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (slot[1:] != slot[:-1])))
        kept = {name: column[first] for name, column in rows.items()}
        kept["_last"], kept["_events"] = np.maximum.reduceat(rows["_last"], first), np.add.reduceat(rows["_events"], first)
        return kept

    return shrink
