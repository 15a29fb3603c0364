"""Cut large groups into ordered blocks, so that no task ever sorts a whole hot group.

Row-level running results (a total after each event, a flag on each event) need the events of a key in order.
A window over the key alone would send every row of a hot key to one task. Here a hash picks about one row in
`stride` as a pivot. The pivots of a key cut its ordered rows into blocks; a window then runs over (key, block)
and a small table of block summaries supplies what earlier blocks contribute. Keys without a pivot are one block.
The pick depends on row values only, so every use of the plan, and every retry of a task, cuts in the same places.

`stride` grows with the table such that about PIVOT_LIMIT pivots exist however large the table is. This bounds
everything that is broadcast here: pivots, and one summary per block.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showpulse.operators.columns import attach

PAGE = 512
PIVOT_LIMIT = PAGE * PAGE
ROWS_PER_BLOCK = 1_000_000


class Blocks(NamedTuple):
    rows: DataFrame  # every row, with its `_block`
    split: DataFrame  # only rows of keys with more than one block; keys and order columns only


def _rank(pivots: Column, row: Column) -> Column:
    """How many of at most 2*PAGE - 1 sorted pivots are not after the row, by binary search; 0 without pivots."""
    steps = F.array(*(F.lit(PAGE >> i) for i in range(PAGE.bit_length())))
    search = F.reduce(
        steps,
        F.lit(0),
        lambda low, step: F.when(F.get(pivots, low + step - 1) <= row, low + step).otherwise(low),
    )
    most = 2 * PAGE - 1
    beyond = F.raise_error(F.lit(f"more than {most} pivots in one list")).cast("int")
    return F.when(pivots.isNull(), F.lit(0)).when(F.size(pivots) > most, beyond).otherwise(search)


def _locate(df: DataFrame, index: DataFrame, pages: DataFrame, keys: list[str], order: list[str], how: str) -> DataFrame:
    row = F.struct(*order)
    paged = attach(df, index, keys, how).withColumn("_page", _rank(F.col("_index"), row) - 1).drop("_index")
    found = attach(paged, pages, [*keys, "_page"])
    block = F.when(F.col("_page") < 0, F.lit(0)).otherwise(F.col("_page") * PAGE + _rank(F.col("_pivots"), row))
    return found.withColumn("_block", block).drop("_page", "_pivots")


def split_groups(df: DataFrame, keys: list[str], order: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> Blocks:
    """`order` must order the rows of a key completely (a time and an event id, say)."""
    narrow = df.select(*dict.fromkeys([*keys, *order]))
    wanted = F.greatest(F.lit(rows_per_block), F.ceil(F.count(F.lit(1)) / F.lit(PIVOT_LIMIT)))
    stride = df.agg(wanted.alias("stride")).scalar()
    picked = narrow.where(F.pmod(F.xxhash64(*keys, *order), stride) == 0)
    pivots = picked.select(*keys, F.struct(*order).alias("_at")).distinct()
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1
    pages = (
        pivots.withColumn("_page", F.floor(number / PAGE).cast("int"))
        .groupBy(*keys, "_page")
        .agg(F.sort_array(F.collect_list("_at")).alias("_pivots"))
    )
    index = pages.groupBy(*keys).agg(F.sort_array(F.collect_list(F.col("_pivots")[0])).alias("_index"))
    return Blocks(
        rows=_locate(df, index, pages, keys, order, "left"),
        split=_locate(narrow, index, pages, keys, order, "inner"),
    )
