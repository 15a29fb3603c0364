"""Token ids of texts by an installed library, which encodes each distinct stretch of text once.

A text is cut where the tokenizer cuts it for certain, and the ids of each piece are remembered in the task. Rare pieces, long
pieces and what cannot be cut go to the library as they are, so the ids are the library's in any case.

Ids are little-endian unsigned 32-bit integers, one after another in bytes.
"""

import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from showpulse.llm.columns import add_columns
from showpulse.llm.token_counts import byte_letters

MEMORY = 96 << 20
"""Bytes of remembered pieces, about: beyond them, those that have not been met since the last such time are forgotten."""
ENTRY = 200  # bytes of an entry besides its texts, about
LONGEST = 100  # characters of a piece that is remembered
SLICE = 1 << 20
"""Characters of a text that are cut into pieces at once."""

ID = np.dtype("<u4")
# Letters whose class and lower case no version of Unicode disputes: those of ASCII, Latin-1 and Latin Extended-A, without the
# dotted capital I, whose lower case is two characters. The first pattern is what texts are cut by before they are lowered.
UPPER = "A-Z\xc0-\xd6\xd8-\xde"
LOWER = "a-z\xdf-\xf6\xf8-\u012f\u0131-\u017e"
MARKS = "".join(map(chr, range(0x21, 0x7F)))  # with digits and the letters of ASCII


class Memory(dict):
    """What `encode` makes of a piece, remembered; about twice MEMORY bytes are held at most, by `size` of the results."""

    def __init__(self, encode: Callable[[str], object], size: Callable[[object], int] = len) -> None:
        super().__init__()
        self.encode, self.size, self.held = encode, size, 0
        self.old: dict = {}

    def __missing__(self, piece: str) -> object:
        made = self.old.get(piece)
        if made is None:
            made = self.encode(piece)
        if len(piece) <= LONGEST:
            if self.held > MEMORY:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self[piece] = made
            self.held += ENTRY + len(piece) + self.size(made)
        return made


def slices(text: str) -> Iterator[str]:
    """A text in parts of about SLICE characters, cut before a space or line end that follows neither."""
    border = re.compile(r"(?<=\S)(?=[ \n])")
    start = 0
    while len(text) - start > SLICE and (cut := border.search(text, start + SLICE)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def library(tokenizer: str) -> Tokenizer:
    """A tokenizer from the text of its file, without padding or truncation."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores
    made = Tokenizer.from_str(tokenizer)
    made.no_truncation()
    made.no_padding()
    return made


def packed_ids(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class PreTokens:
    """Ids of plain pieces by their pre-tokens, each of which the library's merges see once, and of others by the library.

    `plain` gives the text that is cut into pre-tokens, or None for a piece that is not plain. A pre-token alone is a piece
    that is its own only pre-token, so `known` remembers both alike.
    """

    def __init__(self, tokenizer: Tokenizer, pattern: str, plain: Callable[[str], str | None]) -> None:
        self.tokenizer, self.findall, self.plain = tokenizer, re.compile(pattern).findall, plain
        self.merge, self.letters = tokenizer.model.tokenize, byte_letters()
        self.known = Memory(self.encode).__getitem__

    def encode(self, piece: str) -> bytes:
        if (text := self.plain(piece)) is None:
            return packed_ids(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        pre_tokens = self.findall(text)
        if pre_tokens != [piece]:
            return b"".join(map(self.known, pre_tokens))
        # Printable ASCII characters stand for themselves, a space does not.
        if not text.isascii() or text[0] == " ":
            text = "".join([self.letters[b] for b in text.encode()])
        return packed_ids([t.id for t in self.merge(text)])


@lru_cache(maxsize=1)
def word_ids(tokenizer: str) -> Callable[[str], bytes]:
    """A function from a text to its ids, for the tokenizer file with word ends; special strings as is its default.

    `tokenizer` is the text of the file. Spaces and line ends separate its pre-tokens and take part in no normal form, so
    what lies between them is encoded on its own.
    """
    found = library(tokenizer)
    special = {t.content[0] for t in found.get_added_tokens_decoder().values()}
    plainly = re.compile(f"[{re.escape(''.join(c for c in MARKS if c not in special))}{UPPER}{LOWER}]*").fullmatch

    def plain(piece: str) -> str | None:
        return piece.lower() if plainly(piece) else None

    pattern = f"'s|'t|'re|'ve|'m|'ll|'d|[{LOWER}]+|[0-9]|[^{LOWER}0-9]+"
    known = PreTokens(found, pattern, plain).known

    def ids(text: str) -> bytes:
        return b"".join([b"".join(map(known, part.replace("\n", " ").split(" "))) for part in slices(text)])

    return ids


def tokenized(df: DataFrame, path: str, end: int | None = None, text: str = "text") -> DataFrame:
    """`df` with `ids` (binary) of each text, and then the id `end`, if given. A null text counts as empty."""
    with open(path, encoding="utf-8") as file:
        tokenizer = df.sparkSession.sparkContext.broadcast(file.read())
    tail = b"" if end is None else packed_ids([end])

    def make() -> Callable:
        ids = word_ids(tokenizer.value)
        return lambda texts: [pa.array([ids(t or "") + tail for t in texts], pa.binary())]

    return add_columns(df, [text], "ids binary", make)
