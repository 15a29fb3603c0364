"""Personal data in texts: fixed patterns, and spans that a character tagger trained on their matches adds.

The tagger is a bidirectional LSTM with CRF transitions, trained from the pattern matches of a bounded sample of texts. Each
text is cut into overlapping windows on a fixed grid. A span must hold a digit or an "@", so windows without either are not
run. Where windows overlap, their scores are averaged, each weighing most in its middle, and one best path is decoded over
every stretch of windows that touch. Spans that overlap a pattern's match are dropped: patterns stay as they are.

Texts: null counts as empty, which has no spans. Long texts are searched whole, in linear time. Repeated rows are searched
each. Positions count code points, ends are exclusive. Without any match in the sample nothing is added. Input columns named like
an output are replaced. An empty table gives an empty table.
"""

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showpulse.llm import tagger
from showpulse.llm.columns import add_columns

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
SAMPLED = 20_000
"""About so many texts, drawn by a hash of the key, are searched for labelled spans."""
WINDOWS = 4_000
"""At most so many windows with spans, and half as many without, are learned from."""
STEPS = 300
CELLS = 400_000  # characters decoded at once

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++").match
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++").finditer
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++").finditer
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
DIGIT = re.compile(r"[0-9]").search
TELLING = re.compile(r"[0-9@]").finditer


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of a local part, "@" and a domain with a dot.

    A local part cannot hold "@", so each "@" is tried once with the characters before it back to the last match.
    """
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        end = at + 1
        if start < at and (domain := DOMAIN(text, end)):
            free = end = domain.end()
            found.append((start, end))
        at = text.find("@", end)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_byte(digits: str) -> bool:
    digits = digits.lstrip("0") or "0"
    return len(digits) < 4 and int(digits) < 256


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def matches(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of the patterns' matches, by kind and start."""
    found = [(0, *span) for span in emails(text)] if "@" in text else []
    if DIGIT(text):
        found += [(1, *m.span()) for m in IP(text) if all(map(_is_byte, m[0].split(".")))]
        found += [(2, *m.span()) for m in CARD(text) if _is_card(m[0])]
        found += [(3, *m.span()) for m in PHONE(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def tags_of(spans: list[tuple[int, int, int]], length: int) -> np.ndarray:
    """0 outside spans, 1 + 2 * kind at the start of one, 2 + 2 * kind inside; of overlapping spans the first listed wins."""
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        if not tags[start:end].any():
            tags[start:end] = 2 + 2 * kind
            tags[start] = 1 + 2 * kind
    return tags


def padded(ids: np.ndarray, start: int) -> np.ndarray:
    part = ids[start : start + WINDOW]
    return np.concatenate([part, np.full(WINDOW - len(part), tagger.PADDING)])


def labelled_windows(text: str) -> list[tuple[bool, list[int], list[int]]]:
    """Grid windows of a text that hold a digit or "@", and its first one: whether they hold a span, codes and tags."""
    ids, spans = tagger.codes(text), matches(text)
    tags = tags_of(spans, len(text))
    made = []
    for w in sorted({0, *_windows(text)}):
        part = tags[w * STRIDE : w * STRIDE + WINDOW]
        # A span cut off at the left edge begins there as far as the window goes.
        if len(part) and part[0] and part[0] % 2 == 0:
            part = np.concatenate([[part[0] - 1], part[1:]])
        part = np.concatenate([part, np.zeros(WINDOW - len(part), np.int64)])
        made.append((bool(part.any()), padded(ids, w * STRIDE).tolist(), part.tolist()))
    return made


def _windows(text: str) -> set[int]:
    """Numbers of the grid windows that hold a digit or "@"; window w begins at w * STRIDE."""
    return {w for m in TELLING(text) for w in (m.start() // STRIDE, m.start() // STRIDE - 1) if w >= 0}


def fit(df: DataFrame, key: str = "doc_id", text: str = "text") -> tagger.Tagger | None:
    """Train on windows of about SAMPLED texts; None if they hold no span. At most 1.5 * WINDOWS windows reach the driver."""
    n = df.count()
    share = min(1.0, SAMPLED / max(n, 1))
    drawn = F.shiftrightunsigned(F.xxhash64(key, F.lit("personal")), 12) / float(2**52) < share
    rows = df.where(drawn).select(F.col(text).alias("text"))

    def make() -> Callable:
        def columns(texts: list[str | None]) -> list:
            return [[[{"hit": h, "ids": i, "tags": g} for h, i, g in labelled_windows(t or "")] for t in texts]]

        return columns

    cut = add_columns(rows, ["text"], "w array<struct<hit: boolean, ids: array<int>, tags: array<int>>>", make)
    windows = cut.select(F.explode("w").alias("w")).select("w.*").withColumn("o", F.xxhash64("ids"))
    some = [windows.where(c).orderBy("o", "ids").limit(m).collect() for c, m in (("hit", WINDOWS), ("NOT hit", WINDOWS // 2))]
    if not some[0]:
        return None
    both = some[0] + some[1]
    return tagger.train(len(KINDS), np.array([r.ids for r in both]), np.array([r.tags for r in both]), STEPS)


def _weights() -> np.ndarray:
    place = np.arange(WINDOW)
    return np.minimum(place, WINDOW - 1 - place) + 1.0


def added(model: tagger.Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Kind, start and end of the spans that the tagger finds in each text."""
    stretches, parts = [], []  # text, first window and number of windows; codes of the windows
    for n, text in enumerate(texts):
        numbers = sorted(_windows(text))
        if not numbers:
            continue
        ids = tagger.codes(text)
        parts += [padded(ids, w * STRIDE) for w in numbers]
        cuts = [0, *(i + 1 for i in range(len(numbers) - 1) if numbers[i + 1] != numbers[i] + 1), len(numbers)]
        stretches += [(n, numbers[a], b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not parts:
        return out
    moves, weight = model.weights["moves"] + model.allowed, _weights()[:, None]
    emitted = np.concatenate([model.emissions(np.stack(parts[i : i + 2_048])) for i in range(0, len(parts), 2_048)])
    at = np.cumsum([0, *(count for _, _, count in stretches)])
    order = sorted(range(len(stretches)), key=lambda s: stretches[s][2])
    while order:
        # Stretches of like length are decoded together.
        most = max(1, CELLS // (stretches[order[0]][2] * STRIDE + STRIDE))
        some, length = [], 0
        while order and len(some) < most:
            longer = stretches[order[0]][2] * STRIDE + STRIDE
            if some and longer * (len(some) + 1) > CELLS:
                break
            some.append(order.pop(0))
            length = longer
        merged = np.full((len(some), length, emitted.shape[2]), tagger.FORBIDDEN)
        merged[:, :, 0] = 0.0
        for row, s in enumerate(some):
            count = stretches[s][2]
            total, weights = np.zeros((count * STRIDE + STRIDE, emitted.shape[2])), np.zeros((count * STRIDE + STRIDE, 1))
            for k in range(count):
                total[k * STRIDE : k * STRIDE + WINDOW] += weight * emitted[at[s] + k]
                weights[k * STRIDE : k * STRIDE + WINDOW] += weight
            merged[row, : len(total)] = total / weights
        for s, path in zip(some, tagger.best_paths(merged, moves), strict=True):
            n, first, _ = stretches[s]
            out[n] += _spans(path, first * STRIDE, texts[n])
    return [sorted(spans) for spans in out]


def _spans(path: np.ndarray, offset: int, text: str) -> list[tuple[int, int, int]]:
    found = []
    for start in np.flatnonzero(path % 2):
        kind, end = (int(path[start]) - 1) // 2, int(start) + 1
        while end < len(path) and path[end] == 2 + 2 * kind:
            end += 1
        low, high = offset + int(start), min(offset + end, len(text))
        if any(True for _ in TELLING(text, low, high)):
            found.append((kind, low, high))
    return found


def found_in(df: DataFrame, model: tagger.Tagger | None, text: str = "text") -> DataFrame:
    """`df` with personal, the spans of each text by kind and start; base tells the patterns' matches."""

    def make() -> Callable:
        def columns(texts: list[str | None]) -> list:
            texts = [t or "" for t in texts]
            more = added(model, texts) if model else [[] for _ in texts]
            out = []
            for t, extra in zip(texts, more, strict=True):
                base = matches(t)
                extra = [x for x in extra if not any(x[1] < end and start < x[2] for _, start, end in base)]
                both = sorted([(*x, True) for x in base] + [(*x, False) for x in extra])
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in both])
            return [out]

        return columns

    return add_columns(df, [text], "personal array<struct<kind: string, start: int, end: int, base: boolean>>", make)


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(df: DataFrame, model: tagger.Tagger | None, text: str = "text") -> DataFrame:
    """`df` with each span in the text replaced by its kind in brackets; overlapping spans are replaced as one. Null stays.

    A pattern may match anew once its neighbour is gone, so patterns are replaced until none matches.
    """

    def make() -> Callable:
        def columns(texts: list[str | None], spans: list[list[dict]]) -> list:
            return [[t and _clean(t, s) for t, s in zip(texts, spans, strict=True)]]

        return columns

    names = df.columns
    found = found_in(df, model, text)
    return add_columns(found, [text, "personal"], f"`{text}` string", make).select(*names)


def _clean(text: str, spans: list[dict]) -> str:
    while spans:
        text = _without(text, spans)
        spans = [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in matches(text)]
    return text


def _without(text: str, spans: list[dict]) -> str:
    parts, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])
