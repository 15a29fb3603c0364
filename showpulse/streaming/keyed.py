"""Keyed state on streams for any function of arrays.

Keys share small pages of state by their hash. A micro-batch calls the function once for each page that it touches, with the
page's touched keys, their rows in order and their states; only these pages are written, so what a trigger writes follows the
keys in it and not the keys that are alive. A page with no events is not read either, until all its keys have been idle for
`gap` and it is given up; keys of a page that is touched again are given up then.
"""

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from showpulse.functions.durations import micros
from showpulse.operators.columns import names

PAGES = 1 << 16
"""Pages that keys are dealt to. A tenth of the keys that are alive, or more, keeps pages small; a page costs nothing until one
of its keys is met. The number must stay the same as long as a checkpoint is used."""
ROWS_AT_ONCE = 200_000
"""Rows of a page that are held before `shrink` is applied to them."""

Arrays = dict[str, np.ndarray]
Function = Callable[[Arrays, Arrays, Arrays], tuple[Arrays, Arrays]]

_NUMPY = {T.LongType: np.int64, T.IntegerType: np.int32, T.DoubleType: np.float64, T.BooleanType: np.bool_}


def stateful_map(
    df: DataFrame,
    keys: str | Sequence[str],
    func: Function,
    state: T.StructType | str,
    output: T.StructType | str,
    ts: str = "ts",
    order: str | Sequence[str] = (),
    gap: str | None = "3600 seconds",
    clock: str = "event",
    lateness: str = "0 seconds",
    mode: str = "append",
    seen: str | None = None,
    shrink: Callable[[Arrays], Arrays] | None = None,
    pages: int = PAGES,
) -> DataFrame:
    """What `func(keys, rows, states)` makes of each micro-batch of the stream `df`, as a stream of `output` rows.

    `keys`: for each key met, the key columns. `rows`: the columns of `df` and `key`, the place of a row's key in `keys`; rows
    are ordered by key, `ts` and `order`, null before others. `states`: for each key the columns of `state`, `known` (whether
    the key has a state; without one, numbers are 0 and other values None), and `seen`, the latest time of its rows so far. All
    are numpy arrays; times are microseconds since 1970. `func` gives the columns of `output`, whose times are
    microseconds too, and the keys' new states.

    A key whose latest time (by the column `seen`, or `ts`) is `gap` ago is given up; with None, no key ever is. `clock` says
    by what: "event" goes by event times with a watermark of `lateness`, and Spark drops rows behind that; "processing" goes by
    the wall clock as well, for streams whose time is that of arrival. Rows without a time are left out. A key may be given
    up later than its gap, so `func` must compare times itself where that matters.

    A page's rows of one micro-batch are held together. `shrink(rows)` may give fewer rows in their place, and is used whenever
    ROWS_AT_ONCE have come, so that a hot key needs no more memory than that.
    """
    key_names, by = names(keys), [ts, *names(order)]
    state, output = (T.StructType.fromDDL(s) if isinstance(s, str) else s for s in (state, output))
    seen = seen or ts
    width = None if gap is None else micros(gap)
    times = {field.name for field in df.schema if isinstance(field.dataType, T.TimestampType)}
    timed = df.where(F.col(ts).isNotNull()).select(
        *((F.unix_micros(name) if name in times else F.col(name)).alias(name) for name in df.columns),
        F.pmod(F.xxhash64(*key_names), F.lit(pages)).cast("int").alias("_page"),
        (F.col(seen) if seen in times else F.timestamp_micros(seen)).alias("_clock"),
    )
    if clock == "event" and gap is not None:
        timed = timed.withWatermark("_clock", lateness)
    columns = df.columns
    key_fields = [timed.schema[name] for name in key_names]
    held = T.StructType(
        [
            *(T.StructField(f"key{i}", T.ArrayType(field.dataType)) for i, field in enumerate(key_fields)),
            T.StructField("seen", T.ArrayType(T.LongType())),
            *(T.StructField(f"state_{field.name}", T.ArrayType(field.dataType)) for field in state),
        ]
    )
    plain = T.StructType([T.StructField(f.name, T.LongType() if _is_time(f) else f.dataType) for f in output])

    def call(_: tuple, frames: Iterable[pd.DataFrame], page: GroupState) -> Iterator[pd.DataFrame]:
        if page.hasTimedOut:
            page.remove()
            return
        stored = page.get if page.exists else [[] for _ in held]
        numbers = Numbers()
        for key in zip(*stored[: len(key_names)], strict=True):
            numbers[key]
        rows = _gathered(frames, columns, key_names, by, numbers, shrink)
        touched, rows["key"] = np.unique(rows["key"], return_inverse=True)
        every = list(numbers)
        met = [every[i] for i in touched]
        at_hand = {f.name: _array([key[i] for key in met], f) for i, f in enumerate(key_fields)}
        n_stored = len(stored[0])
        old = _extended(stored[len(key_names)], len(every), np.int64)
        last = np.where(np.arange(len(every)) < n_stored, old, np.iinfo(np.int64).min)
        values = [
            _extended(column, len(every), _NUMPY.get(type(field.dataType), object))
            for column, field in zip(stored[len(key_names) + 1 :], state, strict=True)
        ]
        states = {field.name: column[touched] for field, column in zip(state, values, strict=True)}
        made, new = func(at_hand, rows, states | {"known": touched < n_stored, "seen": old[touched]})
        np.maximum.at(last, touched[rows["key"]], np.asarray(rows[seen], np.int64))
        for field, column in zip(state, values, strict=True):
            column[touched] = new[field.name]
        live = np.flatnonzero(_live(last, page, width, clock))
        alive = [every[i] for i in live]
        page.update(
            (
                *([key[i] for key in alive] for i in range(len(key_names))),
                last[live].tolist(),
                *(column[live].tolist() for column in values),
            )
        )
        if width is not None:
            _forget_when_idle(page, int(last.max()), width, clock)
        if len(made[plain.names[0]]):
            yield pd.DataFrame({name: made[name] for name in plain.names})

    result = timed.groupBy("_page").applyInPandasWithState(call, plain, held, mode, _timeout(clock, gap))
    return result.select(*((F.timestamp_micros(f.name) if _is_time(f) else F.col(f.name)).alias(f.name) for f in output))


class Numbers(dict):
    """Numbers for keys, in the order they were first met."""

    def __missing__(self, key: tuple) -> int:
        self[key] = n = len(self)
        return n


def _is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.TimestampType)


def _array(values: list, field: T.StructField) -> np.ndarray:
    kind = _NUMPY.get(type(field.dataType), object)
    if kind is object or None in values:
        made = np.empty(len(values), object)
        made[:] = values
        return made
    return np.array(values, kind)


def _extended(values: list, n: int, kind: type) -> np.ndarray:
    made = np.full(n, None, object) if kind is object else np.zeros(n, kind)
    for i, value in enumerate(values):
        made[i] = value
    return made


def _gathered(
    frames: Iterable[pd.DataFrame],
    columns: list[str],
    keys: list[str],
    by: list[str],
    numbers: Numbers,
    shrink: Callable[[Arrays], Arrays] | None,
) -> Arrays:
    """The rows of a page in order, with the numbers of their keys; shrunk now and then so that few are held."""
    held: list[Arrays] = []
    n = 0
    for frame in frames:
        part = {name: frame[name].to_numpy() for name in columns}
        key_rows = zip(*(part[name].tolist() for name in keys), strict=True)
        part["key"] = np.fromiter((numbers[key] for key in key_rows), np.int64, len(frame))
        held.append(part)
        n += len(frame)
        if shrink is not None and n > ROWS_AT_ONCE:
            held = [shrink(_ordered(held, by))]
            # What is left may be many rows; the next time waits for as many again.
            n = 0
    return _ordered(held, by)


def _ordered(parts: list[Arrays], by: list[str]) -> Arrays:
    whole = {name: np.concatenate([part[name] for part in parts]) if len(parts) > 1 else parts[0][name] for name in parts[0]}
    if len(whole["key"]) < 2:
        return whole
    at = np.lexsort((*(_ranks(whole[name]) for name in reversed(by)), whole["key"]))
    return {name: column[at] for name, column in whole.items()}


def _ranks(values: np.ndarray) -> np.ndarray:
    """Numbers in the order of the values, with null before others."""
    if values.dtype != object:
        return values
    place = {value: i for i, value in enumerate(sorted({v for v in values if v is not None}))}
    return np.array([-1 if v is None else place[v] for v in values])


def _live(last: np.ndarray, page: GroupState, gap: int | None, clock: str) -> np.ndarray:
    """Which keys are not given up yet."""
    if gap is None:
        return np.ones(len(last), bool)
    now = page.getCurrentProcessingTimeMs() if clock == "processing" else page.getCurrentWatermarkMs()
    return (last + gap) // 1000 + 1 >= now


def _forget_when_idle(page: GroupState, last: int, gap: int, clock: str) -> None:
    if clock == "processing":
        page.setTimeoutDuration(max(gap // 1000, 1))
    else:
        page.setTimeoutTimestamp(max((last + gap) // 1000 + 1, page.getCurrentWatermarkMs() + 1))


def _timeout(clock: str, gap: str | None) -> str:
    kinds = {"event": GroupStateTimeout.EventTimeTimeout, "processing": GroupStateTimeout.ProcessingTimeTimeout}
    return kinds[clock] if gap is not None else GroupStateTimeout.NoTimeout
