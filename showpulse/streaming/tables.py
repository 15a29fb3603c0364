"""Tables that streams write: batches as they come, and parts that merges move them into.

`log/batch_id=N` holds a batch and is replaced when the batch is retried, so that each batch counts once. `parts/…/NAME=V`
holds the rows of finished batches by date or by key bucket. Which folder holds a part, and which batches the parts
hold, is said by the newest record in `commits`. A merge reads the batches that no part holds and the parts they touch, writes
these parts anew beside the old ones, and switches to them by adding one record: readers take one record and see either the
old parts and the batches, or the new parts. Of two merges at once the second to finish fails, and changes nothing.

Batch numbers start over with a new checkpoint; give a new checkpoint a new table path.
"""

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from showpulse.sources.files import file_system, finished


class Commit(NamedTuple):
    """What the newest record says: folders of parts by value, and ranges of the batches that they hold."""

    number: int = -1
    parts: dict[str, str] = {}
    holds: list[list[int]] = []


def write_batch(df: DataFrame, batch_id: int, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write one batch in files of even size: neither one per task and date, nor one huge file for a large date."""
    _write(df, f"{path}/batch_id={batch_id}", partition_by)


def append_batch(df: DataFrame, batch_id: int, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add a batch to the table at `path`."""
    write_batch(df, batch_id, f"{path}/log", partition_by)


def _write(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> None:
    df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def newest_commit(spark: SparkSession, path: str) -> Commit:
    numbers = _records(spark, path)
    return _record(spark, path, numbers[-1]) if numbers else Commit()


def _records(spark: SparkSession, path: str) -> list[int]:
    found = file_system(spark, path).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits/*.json"))
    return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found or [])


def _record(spark: SparkSession, path: str, number: int) -> Commit:
    text = "".join(row.value for row in spark.read.text(f"{path}/commits/{number}.json", wholetext=True).collect())
    return Commit(number, **json.loads(text))


def _commit(spark: SparkSession, path: str, commit: Commit) -> None:
    """Add a record whole, or fail if there is one of its number."""
    fs = spark._jvm.org.apache.hadoop.fs
    draft, target = fs.Path(f"{path}/commits/.{uuid.uuid4()}"), fs.Path(f"{path}/commits/{commit.number}.json")
    file = file_system(spark, path).create(draft, False)
    file.write(json.dumps({"parts": commit.parts, "holds": commit.holds}).encode())
    file.close()
    context = fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    # Without options, a rename does not replace what is there.
    plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(context.makeQualified(draft), context.makeQualified(target), plain)


def unmerged(spark: SparkSession, path: str, commit: Commit) -> list[int]:
    """Finished batches that no part holds."""
    return [n for n in finished(spark, f"{path}/log") if not any(a <= n <= z for a, z in commit.holds)]


def _read(spark: SparkSession, base: str, folders: list[str], schema: StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", base)
    return reader.parquet(*folders) if schema is None else reader.schema(schema).parquet(*folders).select(*schema.names)


def _batches(spark: SparkSession, path: str, batches: list[int], schema: StructType | None, below: str = "") -> DataFrame:
    found = _read(spark, f"{path}/log", [f"{path}/log/batch_id={n}{below}" for n in batches], schema)
    return found if schema is not None else found.withColumn("batch_id", F.col("batch_id").cast("long"))


def _parts(spark: SparkSession, path: str, folders: list[str], name: str, schema: StructType | None) -> DataFrame:
    # Folders of one write lie together; each is read from its own base, so that only `name` is a column.
    by_write: dict[str, list[str]] = {}
    for folder in folders:
        by_write.setdefault(folder.rsplit("/", 1)[0], []).append(f"{path}/{folder}")
    found = [_read(spark, f"{path}/{write}", of_write, schema) for write, of_write in by_write.items()]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole if schema is not None else whole.drop(name)


def rows(
    spark: SparkSession, path: str, part: str, schema: StructType | None = None, values: Sequence[str] | None = None
) -> DataFrame | None:
    """The rows of all parts and unmerged batches, or None if there are none. `part` is the name that parts go by.

    `values` reads the parts of these values only, and of batches that are split by `part` only their folders for these.
    """
    commit = newest_commit(spark, path)
    folders = [f for value, f in commit.parts.items() if values is None or value in values]
    batches = unmerged(spark, path, commit)
    found = [_parts(spark, path, folders, part, schema)] if folders else []
    if batches and values is None:
        found.append(_batches(spark, path, batches, schema))
    elif batches:
        exists = file_system(spark, path).exists
        for value in values:
            below = f"/{part}={value}"
            held = [n for n in batches if exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log/batch_id={n}{below}"))]
            if held:
                found.append(_batches(spark, path, held, schema, below))
    if not found:
        return None
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def merge(
    spark: SparkSession,
    path: str,
    part: str,
    combine: Callable[[DataFrame], DataFrame],
    place: Callable[[DataFrame], DataFrame] = lambda df: df,
    check: Callable[[DataFrame], None] = lambda df: None,
    schema: StructType | None = None,
) -> Commit:
    """Move the finished batches into their parts, writing only parts that they touch.

    `combine` makes the rows of parts from the rows of old parts and batches together; `place` adds the column `part`, whose
    values must be few (dates, or buckets of keys). `check` may refuse the batches. Gives the newest record.
    """
    commit = newest_commit(spark, path)
    batches = unmerged(spark, path, commit)
    if not batches:
        return commit
    new = _batches(spark, path, batches, schema)
    check(new)
    touched = {str(row[0]) for row in place(new).select(part).distinct().collect()}
    old = [folder for value, folder in commit.parts.items() if value in touched]
    whole = new.unionByName(_parts(spark, path, old, part, schema)) if old else new
    write = f"parts/{uuid.uuid4()}"
    _write(place(combine(whole)), f"{path}/{write}", [part])
    made = {value: f"{write}/{part}={value}" for value in touched}
    after = Commit(commit.number + 1, commit.parts | made, _joined(commit.holds, batches))
    _commit(spark, path, after)
    return after


def _joined(holds: list[list[int]], batches: list[int]) -> list[list[int]]:
    ranges: list[list[int]] = []
    for a, z in sorted([*holds, *([n, n] for n in batches)]):
        if ranges and a <= ranges[-1][1] + 1:
            ranges[-1][1] = max(z, ranges[-1][1])
        else:
            ranges.append([a, z])
    return ranges


def purge(spark: SparkSession, path: str) -> None:
    """Delete what the two newest records do not need; a reader that planned by the record before still finds its files."""
    numbers = _records(spark, path)
    if len(numbers) < 2:
        return
    before, now = (_record(spark, path, n) for n in numbers[-2:])
    fs, at = file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    needed = {folder.split("/")[1] for commit in (before, now) for folder in commit.parts.values()}
    gone = [f"{path}/log/batch_id={n}" for n in finished(spark, f"{path}/log") if any(a <= n <= z for a, z in before.holds)]
    gone += [f"{path}/commits/{n}.json" for n in numbers[:-2]]
    for status in fs.globStatus(at(f"{path}/parts/*/_SUCCESS")) or []:
        write = status.getPath().getParent().getName()
        if write not in needed:
            gone.append(f"{path}/parts/{write}")
    for folder in gone:
        fs.delete(at(folder), True)
