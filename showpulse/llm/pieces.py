"""SentencePiece encoding and decoding for merge-type (BPE) models.

A text is encoded by backtracking: at each position take the longest vocabulary string that starts there (found for the
whole chunk in one Aho-Corasick pass) and that may follow the token before, else the next shorter one; positions from
which no way leads to the end are marked in a bitfield. Two tokens may be adjacent if merging their joined text gives the two
back. Exactly one path satisfies that, and it is what merging the whole text gives.

Texts: null counts as empty; an empty text has the end id alone and decodes to "". Every row is encoded, repeated or not.
Characters that no vocabulary string holds become their UTF-8 bytes. Input columns named like an output are replaced. An
empty table gives an empty table.
"""

import codecs
import re
import string
from array import array
from collections.abc import Callable, Sequence

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from showpulse.llm.columns import add_columns
from showpulse.llm.merges import merged

CHUNKS_KEPT = 250_000
"""Encoded chunks and checked pairs that a task remembers, each; it forgets all of them when there are more."""

SPACE = "▁"  # the fixed stand-in for a space


class Pieces:
    """The vocabulary of a model file, with what is proven about it before any text is read."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.end, self.unknown = model.eos_id(), model.unk_id()
        self.bytes = [-1] * 256
        self.surface: list[bytes | None] = [None] * size  # None: a byte
        self.text: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif model.is_control(i):
                self.surface[i] = b""
            elif model.is_unknown(i):
                self.surface[i] = model.decode([i]).encode()
            else:
                self.surface[i] = piece.replace(SPACE, " ").encode()
                self.text[piece] = i
                self.score[piece] = -model.get_score(i)
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        # A vocabulary string that merging takes apart never is a token of an encoding.
        self.tokens = {p: i for p, i in self.text.items() if len(self.merge(p)) == 1}
        # No merge crosses these borders, so a text can be cut there: before a run of spaces, around a line end, and
        # between marks and other characters. Marks: punctuation, and what shares a vocabulary string with it.
        marks = set(string.punctuation)
        while more := {c for p in self.text if marks & set(p) for c in p} - marks - {SPACE}:
            marks |= more
        inside = "".join(map(re.escape, sorted(marks)))
        crossing = f"[^{SPACE}]{SPACE}|.\n|\n.|[{inside}][^{inside}{SPACE}]|[^{inside}{SPACE}][{inside}]"
        if any(re.search(crossing, p, re.DOTALL) for p in self.text):
            raise ValueError("vocabulary strings cross the borders of chunks")
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}\n{inside}]+|{SPACE}*[{inside}]+|{SPACE}+|\n").findall

    def rank(self, left: str, right: str) -> float | None:
        return self.score.get(left + right)

    def merge(self, text: str) -> list[str]:
        return merged([*text], self.rank)


class Encoder:
    """Encodes chunks of text; holds what a task remembers."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.found = ahocorasick.Automaton()
        for piece in pieces.tokens:
            self.found.add_word(piece, piece)
        self.found.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens come out again when their joined text is merged."""
        if (known := self.pairs.get((left, right))) is None:
            if len(self.pairs) >= CHUNKS_KEPT:
                self.pairs.clear()
            self.pairs[left, right] = known = self.pieces.merge(left + right) == [left, right]
        return known

    def tokens(self, chunk: str) -> list[str]:
        """The tokens of a chunk; a character outside the vocabulary stands for itself."""
        n = len(chunk)
        starting: list[list[str]] = [[] for _ in range(n)]  # by start, the longest last
        for last, piece in self.found.iter(chunk):
            starting[last + 1 - len(piece)].append(piece)
        failed = 0  # bit i: no way leads from position i to the end
        path: list[str] = []
        tries: list[int] = []  # for each token of the path and the one to come, how many candidates are left
        at, left = 0, len(starting[0])
        while at < n:
            previous = path[-1] if path else None
            taken = None
            if starting[at]:
                while left and taken is None:
                    left -= 1
                    piece = starting[at][left]
                    if not failed >> at + len(piece) & 1 and (previous is None or self.compatible(previous, piece)):
                        taken = piece
            elif left == 0:
                taken, left = chunk[at], -1  # outside the vocabulary: nothing merges with it
            if taken is not None:
                path.append(taken)
                tries.append(left)
                at += len(taken)
                left = len(starting[at]) if at < n else 0
                continue
            if not path:
                raise ValueError("no sequence of tokens fits")
            failed |= 1 << at
            at -= len(path.pop())
            left = tries.pop()
        return path

    def chunk_ids(self, chunk: str) -> bytes:
        """The ids of a chunk as 32-bit integers."""
        if (known := self.known.get(chunk)) is None:
            if len(self.known) >= CHUNKS_KEPT:
                self.known.clear()
            ids = array("i")
            for token in self.tokens(chunk):
                if (i := self.pieces.tokens.get(token)) is not None:
                    ids.append(i)
                else:
                    ids.extend(self.pieces.bytes[b] for b in token.encode())
            self.known[chunk] = known = ids.tobytes()
        return known

    def ids(self, text: str) -> bytes:
        """The ids of a text, without the end id, as 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.chunk_ids, self.pieces.chunks(SPACE + text.replace(" ", SPACE))))


def _replace_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd", error.start + 1


def decoder(pieces: Pieces) -> Callable[[Sequence[int]], str]:
    """A function from ids to their text. Each byte that belongs to no UTF-8 character becomes a replacement character."""
    surface, byte_of = pieces.surface, pieces.byte_of
    codecs.register_error("showpulse.each", _replace_each)

    def decode(ids: Sequence[int]) -> str:
        parts = [surface[i] for i in ids]
        if None in parts:
            parts = [bytes([byte_of[i]]) if p is None else p for p, i in zip(parts, ids, strict=True)]
        # The space put before the text goes with the first piece that has a surface.
        first = next((k for k, p in enumerate(parts) if p), len(parts))
        if first < len(parts) and parts[first].startswith(b" ") and ids[first] != pieces.unknown:
            parts[first] = parts[first][1:]
        if b"" not in parts[first + 1 : -1]:
            return b"".join(parts).decode("utf-8", "showpulse.each")
        # A control id ends a run of bytes.
        runs = [[]]
        for part, i in zip(parts, ids, strict=True):
            if surface[i] == b"":
                runs.append([])
            runs[-1].append(part)
        return "".join(b"".join(run).decode("utf-8", "showpulse.each") for run in runs)

    return decode


def roundtrip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`df` with the ids of each text, an end id last, and decoded, the text that they stand for.

    The vocabulary, whose size the model file fixes, is read on the driver and broadcast.
    """
    pieces = df.sparkSession.sparkContext.broadcast(Pieces(path))

    def make() -> Callable:
        encoder, decode = Encoder(pieces.value), decoder(pieces.value)
        end = array("i", [pieces.value.end]).tobytes()

        def columns(texts: list[str | None]) -> list:
            encoded = [encoder.ids(t or "") + end for t in texts]
            values = pa.Array.from_buffers(pa.int32(), sum(map(len, encoded)) // 4, [None, pa.py_buffer(b"".join(encoded))])
            offsets = [0]
            for ids in encoded:
                offsets.append(offsets[-1] + len(ids) // 4)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            return [lists, [decode(memoryview(ids).cast("i")) for ids in encoded]]

        return columns

    return add_columns(df, [text], "ids array<int>, decoded string", make)
