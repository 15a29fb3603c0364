"""Alignment of two tokenizers' tokens over the bytes of a text, and how far a text follows the corpus's habits.

A: a byte-level BPE file, which encodes a space and the text. B: a merge-type model that adds that space itself. A batch's
distinct stretches of text are encoded together, unless they are remembered. In each batch of documents, `merge_asof` finds for
each token start the other side's token that covers it, keyed by document; from B's side it looks for the starts that are none
of A's. Both directions together are the links, that is all pairs of tokens whose bytes overlap. Offsets at which tokens of
both sides end cut a document into groups.

The second step counts every pair of ids over all links of the corpus. Each document's pairs are met with these counts: the
most frequent pairs, of which there are at most HEAVY, by broadcast, and all others by a shuffle of the pair.

Texts: null and empty texts, and texts whose tokens' bytes are not the space and the text again, have no tokens: all counts are
0 and `groups` is empty. Whatever the length of a text, it is aligned whole; a task's memory grows with the longest one.
Repeated rows count each, in the corpus too. Of counts that tie for a B id's highest, each is one. Columns of the input
named like an output are replaced. An empty table gives an empty table.
"""

import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showpulse.llm.chunks import ID, LONGEST, LOWER, MARKS, UPPER, Memory, PreTokens, library, packed_ids, slices
from showpulse.llm.columns import add_columns
from showpulse.llm.token_counts import byte_letters
from showpulse.sources.shared import settled

HEAVY = 1 << 18
"""The most pairs whose counts are broadcast."""
BATCH_CHARACTERS = 1 << 20
"""Characters of texts that are aligned at once; a longer text is aligned alone."""
JOINED = 64  # short stretches that B's library encodes at once

SPACE = "▁"  # B's fixed stand-in for a space
OUTPUTS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


class Sides:
    """The two tokenizers, and the bytes of each of their ids."""

    def __init__(self, a: str, b: bytes) -> None:
        self.a, self.b = library(a), sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = UPPER + LOWER
        # One line end before other characters is a pre-token; a longer run of white space is left to the library.
        pattern = f"\n|'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[0-9]+| ?[^ {letters}0-9]+"
        plain = re.compile(f"[ \n]?[{re.escape(MARKS)}{letters}]+").fullmatch
        self.encode_a = PreTokens(self.a, pattern, lambda piece: piece if plain(piece) else None).encode
        byte_of = {letter: i for i, letter in enumerate(byte_letters())}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.bytes_a = [bytes(byte_of.get(c, 0) for c in entry) for entry in entries]
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])
        # An id of either side as text, with what follows it: another id of its side, or the end of its side of the group.
        self.texts = np.array(
            [f"{i}{end}" for size, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for end in ends for i in range(size)],
            dtype=object,
        )
        self.new: dict[str, tuple[bytes, bytes, bool]] = {}  # stretches of the texts at hand that `known` lacked
        self.known = Memory(lambda piece: self.new[piece], lambda made: len(made[0]) + len(made[1]))
        # A line end merges with nothing, so what stands behind one is encoded without a space being added.
        *before, self.line = self.b.encode("\n")
        self.before = len(before)

    def encode_b(self, pieces: list[str]) -> list[bytes]:
        """B's ids for stretches of text. Short ones without a line end are encoded together, with line ends between them."""
        made = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if len(piece) <= LONGEST and "\n" not in piece and not _OTHER_SPACE(piece):
                short.append(i)
            else:
                made[i] = packed_ids(self.b.encode("\n" + piece)[self.before + 1 :])
        ids = array("I")
        for start in range(0, len(short), JOINED):
            together = "".join(["\n" + pieces[i] for i in short[start : start + JOINED]])
            ids.extend(self.b.encode(together)[self.before :])
        lines = np.flatnonzero(np.frombuffer(ids, ID) == self.line) * ID.itemsize
        packed = ids.tobytes()
        starts, ends = (lines + ID.itemsize).tolist(), [*lines[1:].tolist(), len(packed)]
        for i, start, end in zip(short, starts, ends[: len(short)], strict=True):
            made[i] = packed[start:end]
        return made

    def encode(self, pieces: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """The ids of both sides for each stretch of text, and whether the bytes of both are those of the text."""
        a, b = [self.encode_a(piece) for piece in pieces], self.encode_b(pieces)
        raws = [piece.encode() for piece in pieces]
        spelt_a, spelt_b = spelt(a, self.bytes_a, self.length_a), spelt(b, self.bytes_b, self.length_b)
        same = [raw == of_a == of_b for raw, of_a, of_b in zip(raws, spelt_a, spelt_b, strict=True)]
        return list(zip(a, b, same, strict=True))

    def remembered(self, pieces: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """What `encode` makes of each of the pieces, and remembers."""
        made = list(map(self.known.get, pieces))
        lacking = [i for i, known in enumerate(made) if known is None]
        self.new = {pieces[i]: known for i in lacking if (known := self.known.old.get(pieces[i])) is not None}
        unknown = [piece for i in lacking if (piece := pieces[i]) not in self.new]
        self.new.update(zip(unknown, self.encode(unknown), strict=True))
        for i in lacking:
            made[i] = self.known[pieces[i]]
        self.new = {}
        return made

    def all_ids(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Both sides' ids for a space and each text; None where the bytes of either are not that.

        Each distinct stretch of the texts is looked up once; numbers stand for the stretches then.
        """
        cut = [[] if SPACE in text else stretches(" " + text) for text in texts]  # B's bytes hold a space for SPACE
        numbers = defaultdict(count().__next__)
        number = np.fromiter(map(numbers.__getitem__, chain.from_iterable(cut)), np.int64)
        if not numbers:
            return [None] * len(texts)
        a, b, same = zip(*self.remembered([*numbers]), strict=True)
        last = np.cumsum([len(pieces) for pieces in cut])
        doubtful = np.append(0, np.cumsum(~np.array(same)[number]))[last]
        doubtful = np.diff(doubtful, prepend=0) > 0
        of_both = [gathered(a, number, last), gathered(b, number, last)]
        made = []
        for text, pieces, doubt, of_a, of_b in zip(texts, cut, doubtful.tolist(), *of_both, strict=True):
            if doubt:
                whole = (b"".join([of[i] for i in array("I", ids)]) for of, ids in ((self.bytes_a, of_a), (self.bytes_b, of_b)))
                doubt = any(found != b" " + text.encode() for found in whole)
            made.append((of_a, of_b) if pieces and not doubt else None)
        return made

    def ids(self, text: str) -> tuple[bytes, bytes] | None:
        """Both sides' ids for a space and the text; None if the bytes of either are not that."""
        return self.all_ids([text])[0]


def spelt(made: list[bytes], of: list[bytes], lengths: np.ndarray) -> list[bytes]:
    """The bytes that each stretch's ids stand for."""
    ids = np.frombuffer(b"".join(made), ID)
    joined = b"".join(map(of.__getitem__, ids.tolist()))
    ends = np.append(0, np.cumsum(lengths[ids]))[np.cumsum([len(x) for x in made]) // ID.itemsize].tolist() if made else []
    return [joined[start:end] for start, end in zip([0, *ends], ends, strict=False)]


def gathered(made: tuple[bytes, ...], number: np.ndarray, last: np.ndarray) -> list[bytes]:
    """The ids of each text, of whose stretches `number` holds the places in `made`, up to the text's place in `last`."""
    size = np.array([len(x) for x in made]) // ID.itemsize
    start = np.cumsum(size) - size
    end = np.cumsum(size[number])
    ids = np.frombuffer(b"".join(made), ID)
    ids = ids[np.repeat(start[number] - end + size[number], size[number]) + np.arange(end[-1])]
    ends = (np.append(0, end)[last] * ID.itemsize).tolist()
    packed = ids.tobytes()
    return [packed[start:end] for start, end in zip([0, *ends], ends, strict=False)]


@lru_cache(maxsize=1)
def sides(a: str, b: bytes) -> Sides:
    return Sides(a, b)


# White space but spaces and line ends, spelt out, as such a set is searched for faster than a class.
_OTHER_SPACE = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
_STRETCHES = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall


def stretches(text: str) -> list[str]:
    """A text cut before each run of spaces and line ends; with other white space in it, as it is.

    Neither side has a token across such a cut: A's pattern takes white space at the head of a pre-token only, and no string
    of B's vocabulary has a space or line end behind another character.
    """
    if _OTHER_SPACE(text):
        return [text]
    return [piece for part in slices(text) for piece in _STRETCHES(part)]


def covering(starts: np.ndarray, of: np.ndarray, others: np.ndarray, others_of: np.ndarray) -> np.ndarray:
    """For each token start the number of the other side's token that covers it, in the same document."""
    left = pd.DataFrame({"at": starts, "document": of})
    right = pd.DataFrame({"at": others, "document": others_of, "token": np.arange(len(others))})
    return pd.merge_asof(left, right, on="at", by="document")["token"].to_numpy(np.int64)


def among(offsets: np.ndarray, others: np.ndarray, last: int) -> np.ndarray:
    """Whether each offset is one of the others; none is above `last`."""
    held = np.zeros(last + 1, bool)
    held[others] = True
    return held[offsets]


def align(both: Sides, encoded: list[tuple[bytes, bytes]]) -> list[tuple]:
    """OUTPUTS of documents that have tokens."""
    number = np.arange(len(encoded))
    counts = [np.array([len(x[side]) // ID.itemsize for x in encoded]) for side in (0, 1)]
    a, b = (np.frombuffer(b"".join([x[side] for x in encoded]), ID).astype(np.int64) for side in (0, 1))
    in_a, in_b = (np.repeat(number, n) for n in counts)
    # Offsets run on through the batch, so those of both sides are in order.
    end_a, end_b = np.cumsum(both.length_a[a]), np.cumsum(both.length_b[b])
    start_a, start_b = end_a - both.length_a[a], end_b - both.length_b[b]
    # Tokens that start together are found from A's side, so B's side looks for the others alone.
    new = np.flatnonzero(~among(start_b, start_a, end_a[-1]))
    over_a, over_b = covering(start_a, in_a, start_b, in_b), covering(start_b[new], in_b[new], start_a, in_a)
    link_a, link_b = np.append(np.arange(len(a)), over_b), np.append(over_a, new)
    link_in = in_a[link_a]

    cut_a, cut_b = among(end_a, end_b, end_a[-1]), among(end_b, end_a, end_a[-1])
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b  # cuts before a token's end
    texts = np.append(a + cut_a * len(both.bytes_a), b + cut_b * len(both.bytes_b) + 2 * len(both.bytes_a))
    texts = both.texts[texts[np.argsort(np.append(2 * group_a, 2 * group_b + 1), kind="stable")]]

    of_one = len(both.bytes_a) * len(both.bytes_b)  # more than any pair
    pair = np.sort(link_in * of_one + a[link_a] * len(both.bytes_b) + b[link_b])
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    times = np.diff(np.append(first, len(pair)))
    pair_in, pair = np.divmod(pair[first], of_one)

    n_links = np.bincount(link_in, minlength=len(encoded))
    n_groups = np.bincount(in_a[cut_a], minlength=len(encoded))
    to_text, to_pair = np.cumsum(counts[0] + counts[1]), np.cumsum(np.bincount(pair_in, minlength=len(encoded)))
    made, at_text, at_pair = [], 0, 0
    for i in range(len(encoded)):
        groups = "".join(texts[at_text : to_text[i]].tolist())[:-1]
        made.append(
            (counts[0][i], counts[1][i], n_groups[i], n_links[i], groups, pair[at_pair : to_pair[i]], times[at_pair : to_pair[i]])
        )
        at_text, at_pair = to_text[i], to_pair[i]
    return made


def aligned(df: DataFrame, a: str, b: str, text: str = "text") -> DataFrame:
    """`df` with OUTPUTS: tokens of each side, groups, links; the groups' ids as `a1,a2|b1;a3|b2,b3`; the pairs of ids that the
    links hold (A's id times the size of B's vocabulary, plus B's id) and how many links hold each.

    The tokenizers, whose size their files fix, are broadcast.
    """
    with open(a, encoding="utf-8") as file_a, open(b, "rb") as file_b:
        files = df.sparkSession.sparkContext.broadcast((file_a.read(), file_b.read()))
    nothing = (0, 0, 0, 0, "", [], [])

    def make() -> Callable:
        both = sides(*files.value)

        def columns(texts: list[str | None]) -> list:
            made = [nothing] * len(texts)
            for rows in batches(texts):
                found = both.all_ids([texts[i] for i in rows])
                known = [(i, ids) for i, ids in zip(rows, found, strict=True) if ids is not None]
                if known:
                    for (i, _), row in zip(known, align(both, [ids for _, ids in known]), strict=True):
                        made[i] = row
            return [list(column) for column in zip(*made, strict=True)]

        return columns

    return add_columns(df, [text], OUTPUTS, make)


def batches(texts: list[str | None]) -> Iterator[list[int]]:
    """Numbers of the texts that are not empty, about BATCH_CHARACTERS at once."""
    rows, held = [], 0
    for i, text in enumerate(texts):
        if text:
            if rows and held + len(text) > BATCH_CHARACTERS:
                yield rows
                rows, held = [], 0
            rows.append(i)
            held += len(text)
    if rows:
        yield rows


def agreement(aligned: DataFrame, b: str, heavy: int = HEAVY) -> DataFrame:
    """The result of `aligned` with `n_best` and `count_sum` in place of the pairs: links whose pair is a most frequent one of
    its B id over the corpus, and the sum over links of their pair's count over the corpus. `b` is B's model file.
    """
    size = sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()
    row = next(name for n in range(len(aligned.columns) + 1) if (name := f"_row{n}") not in map(str.lower, aligned.columns))
    stored = settled(aligned.withColumn(row, F.monotonically_increasing_id()))
    links = stored.select(F.col(row).alias("row"), F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")

    counted = links.groupBy("pair").agg(F.sum("times").alias("n"))
    best = counted.groupBy(F.pmod("pair", F.lit(size)).alias("b")).agg(F.max("n").alias("most"))  # at most `size` rows
    counts = settled(counted.withColumn("b", F.pmod("pair", F.lit(size))).join(F.broadcast(best), "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    ))
    least = _heavy_from(counts, heavy)
    frequent, others = counts.where(F.col("n") >= least), counts.where(F.col("n") < least)

    def sums(met: DataFrame) -> DataFrame:
        held = F.col("n").isNotNull()
        return met.where(held).groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )

    rest = links.join(F.broadcast(frequent.select("pair")), "pair", "left_anti")
    met = sums(links.join(F.broadcast(frequent), "pair")).unionByName(sums(rest.join(others, "pair")))
    total = met.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = [name for name in aligned.columns if name.lower() not in ("pairs", "times", "n_best", "count_sum")]
    return stored.join(total, stored[row] == total["row"], "left").select(
        *(stored[name] for name in kept),
        F.coalesce(total["n_best"], F.lit(0)).alias("n_best"),
        F.coalesce(total["count_sum"], F.lit(0)).alias("count_sum"),
    )


def _heavy_from(counts: DataFrame, heavy: int) -> int:
    """The least count such that at most `heavy` pairs have it; from a table of counts by their size, in steps of an eighth."""
    step = F.floor(F.log2(F.col("n")) * 8)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).orderBy(
        F.desc("step")
    )
    least, held = np.iinfo(np.int64).max, 0
    for row in sizes.collect():  # at most 504 rows
        held += row.pairs
        if held > heavy:
            break
        least = row.least
    return int(least)

