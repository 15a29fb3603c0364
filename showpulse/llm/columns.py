"""Functions over columns of Arrow batches, applied in tasks."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 256
"""Rows handed to a function at once, so that its lists stay small whatever the length of the texts."""


def add_columns(df: DataFrame, reads: list[str], outputs: str, make: Callable[[], Callable]) -> DataFrame:
    """`df` with the columns of the DDL string `outputs`, which replace input columns of the same names.

    `make` is called once in each task; the function it returns gets a list of values for each column of `reads` and
    returns a list or Arrow array for each output.
    """
    added = T.StructType.fromDDL(outputs)
    names = {field.name.lower() for field in added}
    kept = [i for i, field in enumerate(df.schema) if field.name.lower() not in names]
    read = [df.columns.index(name) for name in reads]
    schema = T.StructType([*(df.schema[i] for i in kept), *added])
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                made = function(*(part.column(i).to_pylist() for i in read))
                made = [a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *made], schema.names)

    return df.mapInArrow(run, schema)
