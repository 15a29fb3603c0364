"""Cross-entropy difference: how much better a target model predicts a text than a background model does.

Both are bigram models of words with one vocabulary, one order and the same smoothing; the background model counts all
texts, the target model the texts marked as target. Every word and every bigram of the texts is in the models, however rare:
what a bigram's discount leaves goes to the single words. A text's score is the mean over its words of the loss under the
background less the loss under the target, in nats: above 0 it is more like the target.

The models grow with the corpus and are in no single place. A task reads its texts in chunks of about CHUNK words; each chunk
asks for its distinct words (their numbers and counts, in WORD_BUCKETS buckets) and then for its distinct bigrams (in buckets
of about BUCKET words of the texts, fewer in small corpora). A bucket adds up what all chunks counted and answers each chunk
that asks, in the order of its request, so a bigram goes to its bucket once a chunk, as two numbers, and only counts come back.
Bigrams lie in a bucket with their context, whose discounts are added up there; a context of more words than a bucket is to
have is spread over several, and a chunk asks them all. Requests and answers are arrays, one row for each chunk and bucket.

Texts: words are runs of letters and digits in lower case; every word of a text counts. Null, empty and wordless texts have
no words and the score 0. Without texts, or without target texts, both models are uniform or all scores compare to a uniform
target. Repeated rows count and are scored each. Input columns named like an output are replaced.
"""

import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showpulse.sources.shared import settled

WORD_SHARE = 0.0
"""Words below this share of all words count as one unknown word; 0 leaves out none."""
PAIR_SHARE = 0.0
"""Bigrams below this share of all words go to the single words; 0 leaves out none."""
DISCOUNT = 0.5
ADDED = 0.5  # to every word's count
CHUNK = 1 << 22
"""Words of a chunk; the texts of a task that has fewer are one chunk."""
ROWS = 64
"""Texts read between two looks at the size of the chunk."""
WORD_BUCKETS = 512
BUCKET = 1 << 21
"""Words of the texts for each bucket of bigrams."""
FEW_BUCKETS, SMALL_BUCKET = 512, 1 << 17
"""Small corpora have up to so many buckets of at least so many words, for more tasks."""
BEGIN, NONE = 2**31 - 1, 2**32 - 1
"""Number of the context that begins a text, and of no word: the chunk asks for the context alone."""
OUTPUTS = "n_words long, target_loss double, background_loss double, score double"
ARROW = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
SUMS = ["target", "background", "target_texts", "background_texts"]

WORDS = re.compile(r"\w+").findall


def words(text: str | None) -> list[str]:
    return WORDS(text.lower()) if text else []


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 in as many bytes a number as each array needs, compressed."""
    head, body = [len(arrays)], []
    for array in arrays:
        wide = np.ascontiguousarray(array, "<i8")
        width = (int(wide.max()).bit_length() + 7) // 8 if len(wide) else 0
        head += [len(wide), width]
        body.append(wide.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    raw = struct.pack(f"<{len(head)}q", *head) + b"".join(body)
    return struct.pack("<q", len(raw)) + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd", 1).decompress(data[8:], *struct.unpack_from("<q", data), asbytes=True)
    (n,) = struct.unpack_from("<q", raw)
    sizes, at, made = struct.unpack_from(f"<{2 * n}q", raw, 8), 8 + 16 * n, []
    for size, width in zip(sizes[::2], sizes[1::2], strict=True):
        wide = np.zeros((size, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size).T
        made.append(wide.view("<i8").reshape(-1))
        at += size * width
    return made


def _joined(rows: list[list[np.ndarray]], columns: int) -> list[np.ndarray]:
    return [np.concatenate([r[i] for r in rows] or [np.zeros(0, np.int64)]) for i in range(columns)]


def _sum(at: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, numbers, size).astype(np.int64)


def _sorted_rows(table: pa.Table) -> list[list[np.ndarray]]:
    order = np.argsort(table.column("bucket").to_numpy(), kind="stable")
    data = table.column("data").to_pylist()
    return [_unpacked(data[i]) for i in order]


def _runs(numbers: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    """The different numbers of a sorted array, and where each lies."""
    there, starts = np.unique(numbers, return_index=True)
    return there, [slice(*x) for x in zip(starts, [*starts[1:], len(numbers)])]


def loss(n: np.ndarray, context: np.ndarray, taken: np.ndarray, single: np.ndarray, total: int, size: int) -> np.ndarray:
    """Of words by the counts of their bigram, its context and the word; `taken` is what the context's bigrams keep.

    Discounted bigrams over single words; the probabilities after every context add up to 1.
    """
    often = np.maximum(context, 1e-9)
    left = np.where(context > 0, np.maximum(1 - taken / often, 1e-9), 1.0)
    return -np.log(np.maximum(n - DISCOUNT, 0) / often + left * (single + ADDED) / (total + ADDED * size))


def _least(share: float, n: int) -> float:
    return max(1.0, share * n)


class Vocabulary:
    """Words by number from 1; 0 is any other word. `size` begins a text and is predicted never."""

    def __init__(self, found: list[str]) -> None:
        self.number = {w: i for i, w in enumerate(sorted(found), 1)}
        self.size = len(self.number) + 1


@dataclass
class Model:
    """Counts of the single words, of contexts, of what their bigrams keep, and of the kept bigrams."""

    single: np.ndarray
    context: np.ndarray
    taken: np.ndarray
    pairs: np.ndarray

    def losses(self, numbers: np.ndarray, at: np.ndarray, hit: np.ndarray, before: np.ndarray) -> np.ndarray:
        n = np.where(hit, self.pairs[at], 0) if len(self.pairs) else np.zeros(len(numbers))
        of = self.context[before], self.taken[before], self.single[numbers]
        return loss(n, *of, self.single.sum(), len(self.single))


@dataclass
class Scorer:
    """The texts to learn from, in chunks. The models in one place are for a look at those of small tables."""

    counted: DataFrame

    @cached_property
    def _whole(self) -> tuple[Vocabulary, np.ndarray, Model, Model]:
        rows = self.counted.where("kind > 0").orderBy("chunk", "kind", "bucket").toArrow().to_pylist()
        found = {r["chunk"]: [] for r in rows}
        for r in rows:
            found[r["chunk"]] += r["words"].split("\n") if r["kind"] == 2 else []
        texts = []
        for r in rows:
            if r["kind"] == 1:
                tokens, lengths, wanted = _unpacked(r["data"])
                parts = np.split(tokens, np.cumsum(lengths))[:-1]
                named = found[r["chunk"]]
                texts += [([named[i] for i in t], bool(g)) for t, g in zip(parts, wanted, strict=True) if len(t)]
        flat = np.array([w for t, _ in texts for w in t], object)
        known, n = np.unique(flat.astype(str), return_counts=True) if len(flat) else ([], np.zeros(0))
        vocabulary = Vocabulary([w for w, k in zip(known, n, strict=True) if k >= _least(WORD_SHARE, len(flat))])
        size, number = vocabulary.size, vocabulary.number
        number_of = [(np.array([number.get(w, 0) for w in t], np.int64), g) for t, g in texts]
        made, codes = [], None
        for only in (False, True):
            some = [t for t, g in number_of if g or not only]
            single = np.concatenate([*some, np.zeros(0, np.int64)])
            before = np.concatenate([*(np.append(size, t[:-1]) for t in some), np.zeros(0, np.int64)])
            every, n = np.unique(before * size + single, return_counts=True)
            if codes is None:
                kept = n >= _least(PAIR_SHARE, len(flat))
                codes, pairs = every[kept], n[kept]
            else:
                pairs = np.zeros(len(codes), np.int64)
                at = np.searchsorted(codes, every)
                hit = at < len(codes)
                hit[hit] = codes[at[hit]] == every[hit]
                pairs[at[hit]] = n[hit]
            taken = np.bincount(codes // size, np.maximum(pairs - DISCOUNT, 0), size + 1)
            made.append(Model(np.bincount(single, minlength=size), np.bincount(before, minlength=size + 1), taken, pairs))
        return vocabulary, codes, made[1], made[0]

    vocabulary = property(lambda self: self._whole[0])
    codes = property(lambda self: self._whole[1])
    target = property(lambda self: self._whole[2])
    background = property(lambda self: self._whole[3])


def _chunked(df: DataFrame, text: str, target: str | None, own: list[str], asks: bool) -> DataFrame:
    """The rows of `df` read into chunks, written as rows of three kinds.

    Kind 0 is an input row (`row` of its chunk) with its columns `own`, if the chunk asks; kind 1 is a chunk's words by their
    numbers in the chunk, the lengths of its texts and their marks; kind 2 is the words of a bucket in the order of their
    numbers, with their counts and how many texts they end. Without `target` the texts are not counted.
    """
    wanted = F.lit(False) if target is None else F.coalesce(F.col(target), F.lit(False))
    kept = [df.schema[name] for name in own] if asks else []
    fields = [T.StructField(f"own_{i}", f.dataType, True) for i, f in enumerate(kept)]
    fixed = T.StructType.fromDDL(
        "kind int, chunk long, row long, asks boolean, bucket int, words string, data binary, "
        + ", ".join(f"{name} long" for name in SUMS)
    )
    schema = T.StructType([*fixed, *fields])
    named = [F.col(_quoted(f.name)).alias(x.name) for f, x in zip(kept, fields, strict=True)]
    rows = df.select(F.col(text).alias("text"), wanted.alias("wanted"), *named)
    counts = target is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = (TaskContext.get().partitionId() << 32) * 2 + counts
        number: dict[str, int] = defaultdict(count().__next__)
        texts: list[np.ndarray] = []
        marks: list[bool] = []
        size, types = 0, None

        def rows_of(n: int, **columns) -> pa.RecordBatch:
            arrays = [columns.get(f.name) for f in schema]
            made = [
                pa.nulls(n, t) if a is None else a if isinstance(a, pa.Array) else pa.array(a, t)
                for a, t in zip(arrays, types, strict=True)
            ]
            return pa.RecordBatch.from_arrays(made, schema.names)

        def handed() -> Iterator[pa.RecordBatch]:
            found = list(number)
            bucket = np.array([crc32(w.encode()) % WORD_BUCKETS for w in found], np.int64)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            lengths, good = np.array([len(t) for t in texts], np.int64), np.array(marks, np.int64)
            tokens = place[np.concatenate(texts)]
            last, full = tokens[np.cumsum(lengths)[lengths > 0] - 1], good[lengths > 0]
            often = [
                _sum(tokens, np.repeat(good, lengths), len(order)),
                np.bincount(tokens, minlength=len(order)),
                _sum(last, full, len(order)),
                np.bincount(last, minlength=len(order)),
            ]
            often = [n if counts else n * 0 for n in often]
            data = _packed(tokens, lengths, good)
            sums = {name: [int(n.sum())] for name, n in zip(SUMS, often, strict=True)}
            yield rows_of(1, kind=[1], chunk=[chunk], asks=[asks], bucket=[-1], data=[data], **sums)
            there, parts = _runs(bucket[order])
            n = len(parts)
            listed = ["\n".join(found[i] for i in order[x]) for x in parts]
            data = [_packed(*(c[x] for c in often)) for x in parts]
            if n:
                yield rows_of(n, kind=[2] * n, chunk=[chunk] * n, asks=[asks] * n, bucket=there, words=listed, data=data)
            number.clear()
            number.default_factory = count().__next__
            texts.clear()
            marks.clear()

        for batch in batches:
            if types is None:
                types = [*(ARROW[f.dataType.simpleString()] for f in fixed), *(c.type for c in batch.columns[2:])]
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                n, first = part.num_rows, len(texts)
                for read in part.column(0).to_pylist():
                    found = words(read)
                    texts.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                    size += len(found)
                marks += part.column(1).to_pylist()
                if asks:
                    there = {f.name: part.column(2 + i) for i, f in enumerate(fields)}
                    at = np.arange(first, first + n)
                    yield rows_of(n, kind=[0] * n, chunk=[chunk] * n, row=at, asks=[asks] * n, **there)
                if size >= CHUNK:
                    yield from handed()
                    chunk, size = chunk + 2, 0
        if texts:
            yield from handed()

    return settled(rows.mapInArrow(run, schema))


def fit(df: DataFrame, text: str, target: str) -> Scorer:
    """Read the words of all rows; `target` names a boolean column that marks the target texts."""
    return Scorer(_chunked(df, text, target, [], False))


def scored(df: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """`df` with n_words, target_loss, background_loss and score, the background's loss less the target's."""
    own = _own(df, [])
    asking = _chunked(df, text, None, own, True)
    return _scored(scorer.counted.unionByName(asking, allowMissingColumns=True), asking, own)


def scored_among(df: DataFrame, text: str, target: str) -> DataFrame:
    """As `scored` with a scorer that learned from the same rows, but reads the texts once and drops them and `target`."""
    own = _own(df, [text, target])
    chunks = _chunked(df, text, target, own, True)
    return _scored(chunks, chunks, own)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _own(df: DataFrame, dropped: list[str]) -> list[str]:
    names = {f.name for f in T.StructType.fromDDL(OUTPUTS)}
    return [name for name in df.columns if name.lower() not in names and name not in dropped]


def _scored(chunks: DataFrame, asking: DataFrame, own: list[str]) -> DataFrame:
    heads = chunks.where("kind = 1")
    totals = [x or 0 for x in heads.agg(*(F.sum(name) for name in SUMS)).first()]
    answers = settled(_word_answers(chunks.where("kind = 2"), _least(WORD_SHARE, totals[1])))
    known = [x or 0 for x in answers.agg(F.sum("n"), *(F.sum(name) for name in SUMS)).first()]
    n = totals[1]
    buckets = max(n // BUCKET, min(n // SMALL_BUCKET, FEW_BUCKETS)) + 1
    setting = Setting(buckets, totals, [x - y for x, y in zip(totals, known[1:], strict=True)], known[0] + 1)
    read = heads.select("chunk", "asks", "bucket", "data").unionByName(
        answers.select("chunk", F.lit(None).cast("boolean").alias("asks"), "bucket", "data")
    )
    by_chunk = read.groupBy("chunk")
    asked = by_chunk.applyInArrow(_pair_requests(setting), "bucket int, chunk long, asks boolean, data binary")
    answered = asked.groupBy("bucket").applyInArrow(
        _pair_answers(_least(PAIR_SHARE, n)), "chunk long, bucket int, data binary"
    )
    scores = by_chunk.cogroup(answered.groupBy("chunk")).applyInArrow(
        _scores(setting), f"chunk long, row long, {OUTPUTS}"
    )
    kept = [F.col(f"own_{i}").alias(name) for i, name in enumerate(own)]
    made = [f.name for f in T.StructType.fromDDL(OUTPUTS)]
    rows = asking.where("kind = 0").select("chunk", "row", *(f"own_{i}" for i in range(len(own))))
    return rows.join(scores, ["chunk", "row"]).select(*kept, *made)


def _word_answers(requests: DataFrame, least: float) -> DataFrame:
    """Number and counts of each word that a chunk asks for; the first row of a bucket has the sums of its known words."""

    def answer(key, table):
        number: dict[str, int] = defaultdict(count().__next__)
        at, counts = [], []
        for found, data in zip(table.column("words").to_pylist(), table.column("data").to_pylist(), strict=True):
            at.append(np.fromiter(map(number.__getitem__, found.split("\n")), np.int64))
            counts.append(_unpacked(data))
        every, size = np.concatenate(at), len(number)
        sums = [_sum(every, n, size) for n in _joined(counts, 4)]
        known = sums[1] >= least
        numbers = np.where(known, 1 + key[0].as_py() + WORD_BUCKETS * np.arange(size, dtype=np.int64), 0)
        if numbers.max() >= BEGIN:
            raise OverflowError("more words than numbers for them")
        data = [_packed(numbers[x], *(n[x] for n in sums)) for x in at]
        first = [int(known.sum()), *(int(n[known].sum()) for n in sums)]
        rest = [pa.array([x] + [0] * (len(at) - 1), pa.int64()) for x in first]
        columns = [table.column("chunk"), table.column("bucket"), pa.array(data, pa.binary()), *rest]
        return pa.table(columns, ["chunk", "bucket", "data", "n", *SUMS])

    schema = "chunk long, bucket int, data binary, n long, " + ", ".join(f"{name} long" for name in SUMS)
    return requests.select("bucket", "chunk", "words", "data").groupBy("bucket").applyInArrow(answer, schema)


@dataclass
class Setting:
    """Numbers of buckets, of words and texts in all and of unknown words, by SUMS, and of known words and the unknown one."""

    buckets: int
    totals: list[int]
    unknown: list[int]
    size: int


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """A hash of each number, from 0 to 2**32 - 1."""
    x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.int64)


class Chunk:
    """A chunk's texts with its answers about words, and its bigrams in the order in which it asks for them."""

    def __init__(self, table: pa.Table, setting: Setting) -> None:
        (tokens, self.lengths, wanted), *answers = _sorted_rows(table)
        self.asks = any(table.column("asks").to_pylist())
        ids, *counts = _joined(answers, 5)
        # Numbers in order; the unknown word, if any, has the counts of all that are, the begin those of the texts.
        self.numbers, first = np.unique(ids, return_index=True)
        unknown = self.numbers == 0
        counts = [np.where(unknown, x, n[first]) for x, n in zip(setting.unknown, counts, strict=True)]
        self.numbers = np.append(self.numbers, BEGIN)
        # A word is a context as often as it occurs but at the end of a text; the begin is one for each text.
        self.single = counts[:2]
        self.context = [np.append(counts[i] - counts[2 + i], setting.totals[2 + i]) for i in (0, 1)]
        now = ids[tokens]
        before = np.empty_like(now)
        before[1:] = now[:-1]
        before[(np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]] = BEGIN
        self.pairs, self.at = np.unique(before << 32 | now, return_inverse=True)
        self.wanted = np.repeat(wanted, self.lengths)
        self.before, self.now = (np.searchsorted(self.numbers, x) for x in (self.pairs >> 32, self.pairs & NONE))

        buckets = setting.buckets
        spread = np.minimum(buckets, 1 + self.context[1] * buckets // max(setting.totals[1], 1))
        home = _mixed(self.numbers) % buckets
        bucket = (home[self.before] + _mixed(self.pairs ^ (self.pairs >> 31)) % spread[self.before]) % buckets
        wide = np.flatnonzero(spread > 1)
        each = np.repeat(wide, spread[wide])
        nth = np.arange(len(each)) - np.repeat(np.cumsum(spread[wide]) - spread[wide], spread[wide])
        codes = np.concatenate([self.pairs, self.numbers[each] << 32 | NONE])
        bucket = np.concatenate([bucket, (home[each] + nth) % buckets])
        by_code = np.argsort(codes, kind="stable")
        narrow = np.uint16 if buckets < 2**16 else np.int64
        self.order = by_code[np.argsort(bucket[by_code].astype(narrow), kind="stable")]
        self.codes, self.bucket = codes[self.order], bucket[self.order]


def _pair_requests(setting: Setting):
    """For each bucket the bigrams of a chunk and how often they occur in its target texts and in all."""

    def ask(key, table):
        chunk = Chunk(table, setting)
        counted = key[0].as_py() % 2
        n = np.zeros((2, len(chunk.codes)), np.int64)
        if counted:
            size = len(chunk.pairs)
            n[0, :size], n[1, :size] = _sum(chunk.at, chunk.wanted, size), np.bincount(chunk.at, minlength=size)
        n = n[:, chunk.order]
        there, parts = _runs(chunk.bucket)
        data = []
        for x in parts:
            codes = chunk.codes[x]
            data.append(_packed(np.diff(codes >> 32, prepend=0), codes & NONE, *n[:, x]))
        m = len(data)
        columns = [there.astype(np.int32), np.full(m, key[0].as_py()), [chunk.asks] * m]
        arrays = [*(pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.bool_()), strict=True))]
        return pa.table([*arrays, pa.array(data, pa.binary())], ["bucket", "chunk", "asks", "data"])

    return ask


def _new(numbers: np.ndarray) -> np.ndarray:
    """Where a number differs from the one before."""
    return np.flatnonzero(np.diff(numbers, prepend=-1))


def _pair_answers(least: float):
    """To each chunk the counts of its bigrams in all texts, and twice what the bucket's bigrams of each context keep."""

    def answer(key, table):
        rows = [_unpacked(x) for x in table.column("data").to_pylist()]
        codes = [np.cumsum(r[0]) << 32 | r[1] for r in rows]
        pairs, at = np.unique(np.concatenate(codes), return_inverse=True)
        counts = [_sum(at, n, len(pairs)) for n in _joined([r[2:] for r in rows], 2)]
        kept = counts[1] >= least
        counts = [np.where(kept, n, 0) for n in counts]
        starts = _new(pairs >> 32)
        contexts = pairs[starts] >> 32
        taken = [np.add.reduceat(np.maximum(2 * n - int(2 * DISCOUNT), 0), starts) for n in counts]
        asks, data, start = table.column("asks").to_numpy(), [], 0
        for code, wants in zip(codes, asks, strict=True):
            own, start = at[start : start + len(code)], start + len(code)
            if wants:
                of = code >> 32
                where = np.searchsorted(contexts, of[_new(of)])
                data.append(_packed(*(n[own] for n in counts), *(n[where] for n in taken)))
        asking = table.filter(pa.array(asks, pa.bool_())).select(["chunk", "bucket"])
        return asking.append_column("data", pa.array(data, pa.binary()))

    return answer


def _scores(setting: Setting):
    """Of a chunk's texts."""

    def score(key, table, answered):
        names = ["chunk", "row", "n_words", "target_loss", "background_loss", "score"]
        chunk = Chunk(table, setting)
        lengths = chunk.lengths if chunk.asks else chunk.lengths[:0]
        full = lengths > 0
        losses = np.zeros((2, len(lengths)))
        if full.any():
            answers = _joined(_sorted_rows(answered), 4)
            # A context begins where it or its bucket is another than before.
            starts = np.union1d(_new(chunk.codes >> 32), _new(chunk.bucket))
            context = np.searchsorted(chunk.numbers, chunk.codes[starts] >> 32)
            ends = (np.cumsum(lengths) - lengths)[full]
            for i in (0, 1):
                taken = np.bincount(context, answers[2 + i], len(chunk.numbers)) / 2
                n = np.empty(len(chunk.codes), np.int64)
                n[chunk.order] = answers[i]
                n = n[: len(chunk.pairs)]
                of = chunk.context[i][chunk.before], taken[chunk.before], chunk.single[i][chunk.now]
                each = loss(n, *of, setting.totals[i], setting.size)[chunk.at]
                losses[i, full] = np.add.reduceat(each, ends) / lengths[full]
        m = len(lengths)
        columns = [np.full(m, key[0].as_py()), np.arange(m), lengths, *losses, losses[1] - losses[0]]
        return pa.table([pa.array(x) for x in columns], names)

    return score
