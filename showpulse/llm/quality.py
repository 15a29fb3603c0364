"""Quality scores learned from preferences: of a good and a bad text, the good one should get the higher score.

A score is a weighted sum of features of the whole text. The weights minimise the Bradley-Terry loss, the logistic loss on
the difference of features of the two texts of a pair, over all pairs of a good and a bad text. The threshold is the quantile
of scores at which as many texts lie below it as are labelled bad; a logistic curve through it turns scores into numbers from
0 to 1. All of it is learned from every labelled text.

The loss of a pair depends on the difference of two scores, so the texts of a class are summed by score, on a grid of steps
of STEP, and the sums of two classes meet on the driver: all pairs at the cost of reading the features twice a Newton step.
Between points of the grid a text counts in parts, which puts the probability of a pair off by 3e-5 at most.

Texts: null counts as empty; empty texts have features, and a score, as others. With labels of one kind or none there is
nothing to prefer and every text gets 0.5. Repeated rows are scored each, and learned from once if their features are equal.
Null labels and labels of unknown rows are left out, and a row with both labels is in both classes. Input columns named like
an output are replaced.
"""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showpulse.llm.columns import add_columns
from showpulse.sources.shared import settled

STEP = 1 / 32
"""From one point of the grid of scores to the next."""
CELLS = 1_000
"""Into so many parts a range of scores is cut at once in search of the threshold."""
PAIRS = 20_000
"""Pairs that `preferred` draws from arrays."""
SLOPES = [2.0**k for k in range(-5, 4)]
KEEP_FROM = 0.3
"""The score at the threshold."""
PENALTY = 1e-3

WORD_WITH_MARK = re.compile(r"\w[^\w\s.,;:'\")-]+(?=\s|$)").findall
FEATURES = 14


def features(text: str | None) -> list[float]:
    """What tells prose from junk: the mix of characters, repetition of words, pairs and lines, and the shape of words."""
    if not text:
        return [0.0] * FEATURES
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum() + counts[128:].sum(), counts[48:58].sum()
    letters, size = upper + lower, counts.sum()
    space = counts[9:14].sum() + counts[32]
    words = text.split()
    n, distinct = len(words), len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = text.split("\n")
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    bare = n - sum(map(bool, map(re.compile(r"\w").search, words)))
    made = [
        np.log1p(n),
        upper / max(letters, 1),
        letters / size,
        digits / size,
        (size - letters - digits - space) / size,
        counts[33:39].sum() / size + counts[64] / size,
        counts[124] / size,
        np.log1p(distinct) / max(np.log1p(n), 1e-9),
        pairs / max(n - 1, 1),
        same / max(n - 1, 1),
        size / max(n, 1) / 10,
        len(set(lines)) / len(lines),
        bare / max(n, 1),
        len(WORD_WITH_MARK(text)) / max(n, 1),
    ]
    return [float(x) for x in made]


def expanded(rows: np.ndarray) -> np.ndarray:
    """Features and their square roots, which tell a little from nothing."""
    return np.hstack([rows, np.sqrt(np.abs(rows))])


@dataclass
class Ranker:
    """Weights of standardised features; scores become numbers from 0 to 1 by `slope` around `threshold`."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float = 0.0
    slope: float = 1.0

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((expanded(rows) - self.mean) / self.scale, -6, 6)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.standard(rows) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(rows), 0.5)
        shift = np.log(KEEP_FROM / (1 - KEEP_FROM))
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.raw(rows) - self.threshold) + shift, -30, 30)))


def newton(size: int, sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The `size` weights of the least penalised loss; `sums` has the gradient and curvature of the mean loss at weights."""
    weights = np.zeros(size)
    for _ in range(30):
        gradient, curvature = sums(weights)
        step = np.linalg.solve(curvature + PENALTY * np.eye(size), gradient + PENALTY * weights)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def preferred(good: np.ndarray, bad: np.ndarray) -> Ranker:
    """Bradley-Terry weights from arrays: PAIRS drawn pairs of a good and a bad row of features. `fit` takes all pairs."""
    both = expanded(np.vstack([good, bad]))
    ranker = Ranker(both.mean(0), np.maximum(both.std(0), 1e-6), np.zeros(both.shape[1]))
    if not len(good) or not len(bad):
        return ranker
    drawn = np.random.default_rng(1)
    rows = np.clip((both - ranker.mean) / ranker.scale, -6, 6)
    first = drawn.integers(0, len(good), PAIRS)
    second = len(good) + drawn.integers(0, len(bad), PAIRS)
    difference = rows[first] - rows[second]

    def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = wrong(difference @ weights)
        return -(difference * p[:, None]).mean(0), (difference * (p * (1 - p))[:, None]).T @ difference / PAIRS

    ranker.weights = newton(both.shape[1], sums)
    return ranker


def wrong(margin: np.ndarray) -> np.ndarray:
    """The probability of the wrong order of pairs whose scores differ by `margin`."""
    return 1 / (1 + np.exp(np.clip(margin, -30, 30)))


def calibrate(ranker: Ranker, good: np.ndarray, bad: np.ndarray, share_bad: float) -> Ranker:
    """Set the threshold at the quantile `share_bad` of all texts' scores, the classes weighted to their true shares.

    For rows in arrays; `fit` does the same with `quantile` and `slope` for rows of a table.
    """
    if not ranker.weights.any():
        return ranker
    raw = np.concatenate([ranker.raw(good), ranker.raw(bad)])
    label = np.repeat([1.0, 0.0], [len(good), len(bad)])
    weight = np.where(label == 1, (1 - share_bad) / len(good), share_bad / len(bad))
    by = np.argsort(raw, kind="stable")
    below = np.searchsorted(np.cumsum(weight[by]), share_bad * (1 - 1e-9))
    edge = raw[by][min(below, len(raw) - 1)]
    upper = raw[by][min(below + 1, len(raw) - 1)]
    ranker.threshold = float((edge + upper) / 2)

    def loss(slope: float) -> float:
        z = np.clip(slope * (raw - ranker.threshold), -30, 30)
        return float((weight * np.log1p(np.exp(np.where(label == 1, -z, z)))).sum())

    ranker.slope = min(SLOPES, key=loss)
    return ranker


def _made(rows: DataFrame, outputs: str, function: Callable) -> DataFrame:
    """The rows that `function` makes, as a list of columns, of the labels and features of each batch of `rows`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                features = batch.column("features").flatten().to_numpy().reshape(-1, FEATURES)
                yield pa.RecordBatch.from_arrays([*map(pa.array, function(batch.column("label").to_numpy(), features))], names)

    names = [output.split()[0] for output in outputs.split(", ")]
    return rows.mapInArrow(run, outputs)


def _sums(rows: DataFrame, by: list[str], values: list[str]) -> np.ndarray:
    """A line for each value of `by`, in their order: these, and the sums of `values`."""
    table = rows.groupBy(*by).agg(*(F.sum(v).alias(v) for v in values)).orderBy(*by).toArrow()
    return np.column_stack([table.column(name).to_numpy() for name in (*by, *values)])


def pair_sums(rows: DataFrame, ranker: Ranker, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the mean loss over all pairs of a good and a bad row at the weights of `ranker`.

    The driver gets sums of the features of rows by class and point of the grid, which the range of scores bounds.
    """
    size = len(ranker.weights)
    names = [f"x{i}" for i in range(size)]
    outputs = ", ".join(f"{x} double" for x in names)

    def by_point(label: np.ndarray, features: np.ndarray) -> list[np.ndarray]:
        x = ranker.standard(features)
        place = x @ ranker.weights / STEP
        point = np.floor(place)
        part = np.concatenate([1 - (place - point), place - point])
        codes = 2 * np.concatenate([point, point + 1]).astype(np.int64) + np.tile(label, 2)
        found, at = np.unique(codes, return_inverse=True)
        return [(found & 1).astype(np.int32), found >> 1, *(np.bincount(at, part * c) for c in (1, *np.tile(x, (2, 1)).T))]

    points = _made(rows, f"label int, point long, n double, {outputs}", by_point)
    summed = _sums(points, ["label", "point"], ["n", *names])
    good, bad = (summed[summed[:, 0] == x, 1:] for x in (1, 0))
    gradient, cross = np.zeros(size), np.zeros((size, size))
    curved = {1: np.zeros(len(good)), 0: np.zeros(len(bad))}
    for start in range(0, len(good), 256):
        some = good[start : start + 256]
        p = wrong((some[:, :1] - bad[:, 0]) * STEP)
        gradient -= (p @ bad[:, 1]) @ some[:, 2:] - (some[:, 1] @ p) @ bad[:, 2:]
        p = p * (1 - p)
        curved[1][start : start + 256] = p @ bad[:, 1]
        curved[0] += some[:, 1] @ p
        cross += some[:, 2:].T @ p @ bad[:, 2:]
    places = {1: good[:, 0], 0: bad[:, 0]}

    def products(label: np.ndarray, features: np.ndarray) -> list[np.ndarray]:
        x = ranker.standard(features)
        place = x @ ranker.weights / STEP
        weight = np.where(label == 1, *(np.interp(place, places[c], curved[c]) for c in (1, 0)))
        return [np.arange(size, dtype=np.int32), *((x * weight[:, None]).T @ x)]

    own = _sums(_made(rows, f"i int, {outputs}", products), ["i"], names)[:, 1:]
    pairs = counts[0] * counts[1]
    return gradient / pairs, (own - cross - cross.T) / pairs


def quantile(scores: DataFrame, weight: dict[int, float], share: float) -> tuple[float, float]:
    """The value of `raw` of the row at which the weights of rows in order of `raw` reach `share`, and of the row after it.

    A row weighs as its `label` says. The range that holds the row is cut into CELLS until it is one value.
    """
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    after, good, bad = high, 0, 0

    def weighed(good: int, bad: int) -> float:
        return good * weight[1] + bad * weight[0]

    while True:
        cell = F.floor((F.col("raw") - low) / (high - low) * (CELLS - 1)) if low < high else F.lit(0)
        inside = scores.where(F.col("raw").between(low, high)).groupBy(cell.alias("cell"))
        sums = [F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")]
        cells = inside.agg(*sums, F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("cell").collect()
        for i, found in enumerate(cells):
            if weighed(good + found.good, bad + found.bad) >= share or i == len(cells) - 1:
                break
            good, bad = good + found.good, bad + found.bad
        after = cells[i + 1].low if i + 1 < len(cells) else after
        low, high = found.low, found.high
        if low == high:
            # Of equal scores the bad come last.
            last = (found.good, found.bad - 1) if found.bad else (found.good - 1, 0)
            return low, low if weighed(good + last[0], bad + last[1]) >= share else after


def slope(scores: DataFrame, weight: dict[int, float], threshold: float) -> float:
    """Of SLOPES, that of the least logistic loss around the threshold."""
    away = (F.col("raw") - threshold) * F.when(F.col("label") == 1, -1.0).otherwise(1.0)
    losses = [F.sum(F.log1p(F.exp(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), away * x))))) for x in SLOPES]
    found = {r[0]: r[1:] for r in scores.groupBy("label").agg(*losses).collect()}
    return min(zip(SLOPES, *(found[c] for c in (1, 0))), key=lambda r: r[1] * weight[1] + r[2] * weight[0])[0]


def fit(texts: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Ranker:
    """Learn from all labelled texts.

    The features of all texts, not the texts, meet the labels in a shuffle; those of labelled ones are written to the shared
    folder and read again for each sum. Sums alone reach the driver.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("label in (0, 1)").distinct()
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("features")).where("key is not null")
    measured = add_columns(rows, ["features"], "features array<double>", lambda: lambda ts: [[features(t) for t in ts]])
    found = settled(measured.distinct().join(known, "key").select("label", "features"))
    counts = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Ranker(np.zeros(2 * FEATURES), np.ones(2 * FEATURES), np.zeros(2 * FEATURES))
    values = [F.col("features")[i] for i in range(FEATURES)]
    values += [F.sqrt(F.abs(x)) for x in values]
    mean, scale = (np.array(found.agg(*map(f, values)).first()) for f in (F.avg, F.stddev_pop))
    scale = np.maximum(scale, 1e-6)
    weights = newton(2 * FEATURES, lambda w: pair_sums(found, Ranker(mean, scale, w), counts))
    ranker = Ranker(mean, scale, np.round(weights, 9))  # sums come in any order
    if not ranker.weights.any():
        return ranker
    labelled = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share_bad = labelled[0] / (labelled[0] + labelled[1])
    weight = {1: (1 - share_bad) / counts[1], 0: share_bad / counts[0]}
    scores = settled(_made(found, "label int, raw double", lambda label, rows: [label, ranker.raw(rows)]))
    ranker.threshold = sum(quantile(scores, weight, share_bad * (1 - 1e-9))) / 2
    ranker.slope = slope(scores, weight, ranker.threshold)
    return ranker


def scored(df: DataFrame, ranker: Ranker, text: str = "text") -> DataFrame:
    """`df` with score, and predicted, 1 from the threshold on and else 0."""

    def make() -> Callable:
        def columns(texts: list[str | None]) -> list:
            scores = ranker.scores(np.array([features(t) for t in texts]))
            return [scores, (scores >= KEEP_FROM).astype(np.int32)]

        return columns

    return add_columns(df, [text], "score double, predicted int", make)
