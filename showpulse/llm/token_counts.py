"""Token counts by whole tokens: most pre-tokens are one token, which is known before any text is read.

Texts: null counts as empty and has no tokens. Repeated rows are counted each. Columns of the input named like an output
are replaced by it. An empty table gives an empty table.
"""

import json
import unicodedata
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from showpulse.llm.columns import add_columns
from showpulse.llm.merges import merged

WORDS_KEPT = 300_000
"""Counts of merged pre-tokens that a task remembers; it forgets all of them when there are more."""

END = "</w>"
# White space and pre-tokens of the tokenizer file, its pattern for pre-tokens with the white space spelt out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters that the tokenizer lowers otherwise than Python: one without regard to its place in a word, two of Unicode 16.
LOWERED = {ord("Σ"): "σ", 0xA7CB: "\u0264", 0xA7DC: "\u019b"}
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabularies at byte level: itself if printable, else one from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Merges of a tokenizer file, and the strings that are proven to encode alone as one token."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.special = [t["content"] for t in model["added_tokens"]]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["model"]["merges"])}
        self.letters = byte_letters()
        of = {letter: byte for byte, letter in enumerate(self.letters)}
        self.whole = set()
        for token in model["model"]["vocab"]:
            if token.endswith(END) and len(token) > len(END) and self._alone(token):
                try:
                    self.whole.add(bytes(of[c] for c in token.removesuffix(END)).decode())
                except (KeyError, UnicodeDecodeError):
                    continue  # not a string that can be a pre-token

    def _alone(self, token: str) -> bool:
        symbols = [*token.removesuffix(END)]
        symbols[-1] += END
        return len(merged(symbols, lambda a, b: self.ranks.get((a, b)))) == 1

    def count(self, word: str) -> int:
        """The tokens of one pre-token, by merging."""
        symbols = [self.letters[b] for b in word.encode()]
        symbols[-1] += END
        return len(merged(symbols, lambda a, b: self.ranks.get((a, b))))


class _Counts(dict):
    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__(dict.fromkeys(vocabulary.whole, 1))
        self.vocabulary, self.most = vocabulary, len(vocabulary.whole) + WORDS_KEPT

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(dict.fromkeys(self.vocabulary.whole, 1))
        self[word] = n = self.vocabulary.count(word)
        return n


def counter(vocabulary: Vocabulary) -> Callable[[str], int]:
    """A function from a text to the number of its tokens."""
    counts = _Counts(vocabulary)
    pre_tokens = regex.compile(PRE_TOKEN).findall
    special = regex.compile("|".join(map(regex.escape, vocabulary.special)))

    def plain(text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).translate(LOWERED)
        return sum(map(counts.__getitem__, pre_tokens(text.lower())))

    def count(text: str) -> int:
        if "<|" not in text:
            return plain(text)
        parts = special.split(text)
        return sum(map(plain, parts)) + len(parts) - 1

    return count


def token_counts(df: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """`df` with n_bytes, n_tokens and over_limit of each text.

    The vocabulary, whose size the tokenizer file fixes, is read on the driver and broadcast.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def make() -> Callable:
        count = counter(vocabulary.value)

        def columns(texts: list[str | None]) -> list:
            n = [count(t) if t else 0 for t in texts]
            return [pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()), n, [x > limit for x in n]]

        return columns

    return add_columns(df, [text], "n_bytes long, n_tokens long, over_limit boolean", make)
