"""Language identification by interpolated Kneser-Ney language models of characters, one for each language.

A model gives each character of a word a probability after the characters before it in the word; a word begins and ends
with a border. Orders 1 to `ORDER` are interpolated with absolute discounts, lower orders count in how many contexts a
character was seen. What a model knows lies in arrays sorted by the hash of the n-gram. A text gets the language whose
model needs the fewest bits for each character. A calibrated check says whether that language is near enough at all.

Texts: null, empty and letterless texts are `und` with score 0. Every word of a text counts, however long the text; words
are runs of letters, in lower case. Of equally good languages the first in order of names wins. With nothing to learn
from, every text is `und`. Repeated rows are judged each. Input columns named like an output are replaced.
"""

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showpulse.llm.columns import add_columns
from showpulse.llm.sampling import sample_per_class

UNKNOWN = "und"
ORDER = 5
DISCOUNT = 0.75
WORDS_KEPT = 200_000
"""Scored words that a task remembers; it forgets all of them when there are more."""
PART = 20_000  # words scored at once
LABELLED = 1_000
"""About so many labelled texts of each language are learned from; a fifth of them calibrates."""
REJECTED = 0.005
"""Share of calibration texts of its own language that a model's limit turns away."""

LETTERS = regex.compile(r"\p{L}+")
BORDER = "\x02"
MIX = np.uint64(0x9E3779B97F4A7C15)  # any odd number


def words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def ngram_counts(counted: Counter) -> dict[int, dict[str, int]]:
    """By order, how often each n-gram occurs in the counted words; shorter ones at the begin of a word keep the border."""
    grams: dict[int, Counter] = {n: Counter() for n in range(1, ORDER + 1)}
    for word, n in counted.items():
        padded = BORDER + word + BORDER
        for end in range(1, len(padded)):
            for order in range(1, min(ORDER, end + 1) + 1):
                grams[order][padded[end + 1 - order : end + 1]] += n
    return grams


def hashes(grams: list[str]) -> np.ndarray:
    """64-bit hashes of n-grams, by their characters from last to first, so that a longer context extends the hash."""
    return np.fromiter((_hash(g) for g in grams), np.uint64, len(grams))


def _hash(gram: str) -> int:
    value = 0
    for c in reversed(gram):
        value = (value ^ (ord(c) + 1)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        value ^= value >> 29
    return value


@dataclass
class Model:
    """Sorted hash arrays for each order: log probability of a seen n-gram, and log weight of what its context leaves over."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    leftovers: list[np.ndarray]
    floor: float  # log probability of a character never seen
    limit: float = math.inf  # bits for each character beyond which the language is rejected


def train(counts: dict[int, dict[str, int]]) -> Model:
    """An interpolated Kneser-Ney model of n-gram counts by order."""
    # An n-gram that does not begin at a border is a lower-order event: it counts its different predecessors.
    usable: dict[int, dict[str, int]] = {ORDER: dict(counts[ORDER])}
    for order in range(ORDER - 1, 0, -1):
        before = Counter(g[1:] for g in counts[order + 1])
        usable[order] = {g: n if g[0] == BORDER and order > 1 else max(1, before[g]) for g, n in counts[order].items()}
    # Highest-order statistics also hold the shorter n-grams at word begins, which no longer context can replace.
    probability: dict[str, float] = {}
    size = len(usable[1]) + 1  # one more for characters never seen
    floor = 1.0 / size
    model = Model([], [], [], [], 0.0)
    lower: Callable[[str], float] = lambda g: floor
    for order in range(1, ORDER + 1):
        total, kinds = Counter(), Counter()
        for g, n in usable[order].items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
        leftover = {c: DISCOUNT * kinds[c] / total[c] for c in total}
        current = {
            g: max(n - DISCOUNT, 0.0) / total[g[:-1]] + leftover[g[:-1]] * lower(g[1:]) for g, n in usable[order].items()
        }
        probability |= current
        grams, contexts = [*current], [*leftover]
        for names, values, keys, logs in (
            (grams, [math.log(current[g]) for g in grams], model.grams, model.logs),
            (contexts, [math.log(leftover[c]) for c in contexts], model.contexts, model.leftovers),
        ):
            hashed = hashes(names)
            by = np.argsort(hashed)
            keys.append(hashed[by])
            logs.append(np.asarray(values)[by])
        if order == 1:
            model.floor = math.log(leftover[""] * floor) if leftover else math.log(floor)

        def lower(g: str, known: dict = probability, weights: dict = leftover, below: Callable = lower) -> float:
            p = known.get(g)
            return p if p is not None else weights.get(g[:-1], 1.0) * below(g[1:])

    return model


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def losses(models: list[Model], batch: list[str]) -> np.ndarray:
    """Bits that each model (columns) needs for each word (rows), the closing border included."""
    text = "".join(BORDER + w + BORDER for w in batch)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in batch), np.int64, len(batch))
    first = np.cumsum(lengths) - lengths
    depth = np.arange(len(codes)) - np.repeat(first, lengths)  # place in the padded word
    spots = np.flatnonzero(depth)  # every character but the opening border is predicted
    # suffix[n]: hash of the n characters that end at a spot; context[n]: of the n before it
    suffix = _suffixes(codes, spots)
    context = _suffixes(codes, spots - 1)
    orders = np.minimum(depth[spots] + 1, ORDER)
    by_word = np.searchsorted(first, spots, "right") - 1
    out = np.empty((len(batch), len(models)))
    for m, model in enumerate(models):
        logs = np.full(len(spots), model.floor)
        done = np.zeros(len(spots), bool)
        weight = np.zeros(len(spots))
        open_ = np.arange(len(spots))
        for order in range(ORDER, 0, -1):
            able = open_[orders[open_] >= order]
            at, hit = _found(model.grams[order - 1], suffix[order][able])
            logs[able[hit]] = weight[able[hit]] + model.logs[order - 1][at[hit]]
            done[able[hit]] = True
            missed = able[~hit]
            if order > 1:
                at, known = _found(model.contexts[order - 1], context[order - 1][missed])
                weight[missed[known]] += model.leftovers[order - 1][at[known]]
            open_ = np.flatnonzero(~done)
        logs[open_] = weight[open_] + model.floor
        out[:, m] = np.bincount(by_word, -logs / math.log(2), len(batch))
    return out


def _suffixes(codes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    value = np.zeros(len(ends), np.uint64)
    made = [value]
    for back in range(ORDER):
        value = (value ^ (codes[np.maximum(ends - back, 0)] + np.uint64(1))) * MIX
        value = value ^ (value >> np.uint64(29))
        made.append(value)
    return made


@dataclass
class Identifier:
    """Models by language in order of names, and how much a difference in bits for each character says."""

    languages: list[str]
    models: list[Model]
    sharpness: float = 1.0


class Judge:
    """Applies an identifier to texts; holds the bits of words that a task remembers."""

    def __init__(self, identifier: Identifier) -> None:
        self.of = identifier
        self.row: dict[str, int] = {}
        self.bits_of = np.zeros((0, len(identifier.languages)))

    def bits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits for each character by text and language, and the number of words of each text."""
        split = [words(t) for t in texts]
        if len(self.row) > WORDS_KEPT:
            self.row.clear()
            self.bits_of = self.bits_of[:0]
        new = [w for w in dict.fromkeys(w for ws in split for w in ws) if w not in self.row]
        made = [losses(self.of.models, new[i : i + PART]) for i in range(0, len(new), PART)]
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))
        self.bits_of = np.concatenate([self.bits_of, *made])
        out = np.zeros((len(texts), len(self.of.languages)))
        for i, ws in enumerate(split):
            if ws:
                rows = np.fromiter(map(self.row.__getitem__, ws), np.int64, len(ws))
                out[i] = self.bits_of[rows].sum(0) / (sum(map(len, ws)) + len(ws))
        return out, np.array([len(ws) for ws in split])

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the language is too far off, for each text."""
        if not self.of.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        bits, n = self.bits(texts)
        best = bits.argmin(1)
        least = bits[np.arange(len(bits)), best]
        share = 1 / np.exp(-self.of.sharpness * (bits - least[:, None])).sum(1)
        far = least > np.array([m.limit for m in self.of.models])[best]
        empty = n == 0
        return (
            [UNKNOWN if e else self.of.languages[b] for e, b in zip(empty, best, strict=True)],
            np.where(empty, 0.0, share),
            far | empty,
        )


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Identifier:
    """Learn from the labelled rows: about LABELLED for each language, drawn by a hash of the key.

    N-grams are counted in tasks; what reaches the driver is the counts of that bounded sample, and the calibration
    texts' bits.
    """
    sample = sample_per_class(labelled.where(F.col(label).isNotNull()).select(key, text, label), key, label, LABELLED)
    rows = sample.select(
        F.col(text).alias("text"), F.col(label).alias("lang"), (F.xxhash64(key, F.lit("fold")) % 5 == 0).alias("held")
    )

    def count(batches):
        counted: dict[str, Counter] = {}
        for batch in batches:
            for t, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counted.setdefault(language, Counter()).update(words(t))
        for language, c in counted.items():
            yield pa.RecordBatch.from_pydict({"lang": [language] * len(c), "word": [*c], "n": [*c.values()]})

    words_of = rows.where(~F.col("held")).mapInArrow(count, "lang string, word string, n long")
    by_language: dict[str, Counter] = {}
    for r in words_of.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toLocalIterator():
        by_language.setdefault(r.lang, Counter())[r.word] = r.n
    languages = sorted(by_language)
    identifier = Identifier(languages, [train(ngram_counts(by_language[x])) for x in languages])
    if not languages:
        return identifier
    judged = _calibration(rows.where("held"), identifier)
    return _calibrated(identifier, judged)


def _calibration(held: DataFrame, identifier: Identifier) -> list:
    shared = held.sparkSession.sparkContext.broadcast(identifier)

    def make() -> Callable:
        judge = Judge(shared.value)

        def columns(texts: list[str | None]) -> list:
            bits, n = judge.bits(texts)
            return [bits.tolist(), n]

        return columns

    made = add_columns(held, ["text"], "bits array<double>, words long", make)
    return made.where("words > 0").select("lang", "bits").collect()


def _calibrated(identifier: Identifier, rows: list) -> Identifier:
    """Limits at the quantile of each language's own texts; the sharpness under which the true languages are likeliest."""
    place = {x: i for i, x in enumerate(identifier.languages)}
    rows = [(place[r.lang], np.array(r.bits)) for r in rows if r.lang in place]
    for i, model in enumerate(identifier.models):
        own = [bits[i] for own, bits in rows if own == i]
        if len(own) >= 20:
            model.limit = float(np.quantile(own, 1 - REJECTED)) * 1.05
    if rows:
        own, bits = np.array([i for i, _ in rows]), np.stack([b for _, b in rows])

        def cost(sharpness: float) -> float:
            scaled = -sharpness * (bits - bits.min(1, keepdims=True))
            return float((np.log(np.exp(scaled).sum(1)) - scaled[np.arange(len(own)), own]).mean())

        identifier.sharpness = min((2.0**k for k in range(8)), key=cost)
    return identifier


def identified(df: DataFrame, identifier: Identifier, text: str = "text") -> DataFrame:
    """`df` with lang_pred, score (0 to 1) and rejected, whether the calibrated check turns the language away.

    The identifier is broadcast; it is as large as the bounded sample it was learned from.
    """
    shared = df.sparkSession.sparkContext.broadcast(identifier)

    def make() -> Callable:
        judge = Judge(shared.value)
        return lambda texts: [*judge.judge(texts)]

    return add_columns(df, [text], "lang_pred string, score double, rejected boolean", make)
