import random
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from test_tokens import MODEL, SPECIAL
from tokenizers import Tokenizer

from showpulse.llm import alignment, chunks, token_counts

A = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


def spans(tokens):
    at = 0
    for token in tokens:
        yield at, at + len(token)
        at += len(token)


def by_hand(texts):
    """Every pair of tokens of every text, compared."""
    a_side, b_side = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_side.encode_special_tokens = True
    byte_of = {letter: i for i, letter in enumerate(token_counts.byte_letters())}
    rows, links = [], []
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(byte_of[c] for c in a_side.id_to_token(i)) for i in a]
        pieces = [(i, b_side.id_to_piece(i)) for i in b]
        b_bytes = [bytes([int(p[3:-1], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        raw = b" " + (text or "").encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            rows.append([0, 0, 0, 0, ""])
            links.append([])
            continue
        in_a, in_b = list(spans(a_bytes)), list(spans(b_bytes))
        found = [(a[i], b[j]) for i, (s, e) in enumerate(in_a) for j, (t, f) in enumerate(in_b) if s < f and t < e]
        groups, start = [], 0
        for end in sorted({e for _, e in in_a} & {e for _, e in in_b}):
            sides = [[str(x) for x, (s, _) in zip(ids, at) if start <= s < end] for ids, at in ((a, in_a), (b, in_b))]
            groups.append("|".join(map(",".join, sides)))
            start = end
        rows.append([len(a), len(b), len(groups), len(found), ";".join(groups)])
        links.append(found)
    counts = Counter(pair for found in links for pair in found)
    best = defaultdict(int)
    for (_, b_id), n in counts.items():
        best[b_id] = max(best[b_id], n)
    for row, found in zip(rows, links):
        row += [sum(counts[p] == best[p[1]] for p in found), sum(counts[p] for p in found)]
    return rows


def texts():
    chosen = random.Random(4)
    letters = "    \n\tabcdeinth.,'|éßß😀123▁中İΣ́  \x1c<>"
    words = ["the", "Étion", "straße", "x1", "don't", "<s>", "<|endoftext|>", "…", "\n", "  ", "¼", "Œuvre"]
    made = [" ".join(chosen.choices(words, k=chosen.randrange(1, 20))) for _ in range(150)]
    made += ["".join(chosen.choices(letters, k=chosen.randrange(50))) for _ in range(250)]
    return [t if t is None else t[:3_000] for t in SPECIAL] + made + made[:60]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "own", b"own", 5) for i, t in enumerate(texts())]
    table = spark.createDataFrame(rows, "doc_id long, text string, groups string, pairs binary, _row0 int")
    return alignment.aligned(table, A, MODEL)


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 40, 0])
def test_equals_all_pairs_by_hand(found, heavy):
    rows = alignment.agreement(found, MODEL, heavy).orderBy("doc_id").collect()
    want = by_hand(texts())
    assert sum(w[0] > 0 for w in want) > 300 and sum(w[0] == 0 for w in want) > 20
    for row, expected in zip(rows, want, strict=True):
        assert [row[c] for c in COLUMNS] == expected, row.text
        assert row._row0 == 5


def test_frequent_pairs_are_bounded(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 500 + [2] * 50 + [90, 95, 4_000])], "pair long, n long")
    assert alignment._heavy_from(counts, 3) == 90
    assert alignment._heavy_from(counts, 60) == 2
    assert alignment._heavy_from(counts, 552) == 2
    assert alignment._heavy_from(counts, 553) == 1
    assert alignment._heavy_from(counts, 0) > 4_000


def test_stretches_give_the_libraries_ids():
    both = alignment.Sides(open(A, encoding="utf-8").read(), open(MODEL, "rb").read())
    chosen = random.Random(9)
    for _ in range(3_000):
        text = "".join(chosen.choices("ab Eé\n.'’1²́  \tßſ", k=chosen.randrange(1, 25)))
        if (ids := both.ids(text)) is not None:
            assert list(array("I", ids[0])) == both.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
            assert list(array("I", ids[1])) == both.b.encode(text), repr(text)


class Counted:
    """B's library, and how often it is asked."""

    def __init__(self, library):
        self.library, self.calls = library, 0

    def encode(self, text):
        self.calls += 1
        return self.library.encode(text)


def test_short_stretches_are_encoded_together():
    both = alignment.Sides(open(A, encoding="utf-8").read(), open(MODEL, "rb").read())
    chosen = random.Random(3)
    text = " ".join("".join(chosen.choices("abcdeéinrst", k=9)) for _ in range(2_000))
    both.b = library = Counted(both.b)
    ids = both.ids(text)
    assert library.calls < 100
    assert list(array("I", ids[0])) == both.a.encode(" " + text, add_special_tokens=False).ids
    assert list(array("I", ids[1])) == library.library.encode(text)
    library.calls = 0
    assert both.ids(text) == ids and library.calls == 0


def test_tokens_that_all_start_together():
    both = alignment.Sides(open(A, encoding="utf-8").read(), open(MODEL, "rb").read())
    ((n_a, n_b, n_groups, n_links, _, pairs, times),) = alignment.align(both, both.all_ids(["the the"]))
    assert (n_a, n_b, n_groups, n_links, len(pairs), list(times)) == (2, 2, 2, 2, 1, [2])


@pytest.mark.parametrize("memory", [chunks.MEMORY, 30_000])
def test_texts_encoded_together_have_the_libraries_ids(monkeypatch, memory):
    monkeypatch.setattr(chunks, "MEMORY", memory)
    both = alignment.Sides(open(A, encoding="utf-8").read(), open(MODEL, "rb").read())
    chosen = random.Random(11)
    for _ in range(40):
        made = ["".join(chosen.choices("abcd Eé\n.'’1²  \t▁\xa0ßſ", k=chosen.randrange(1, 40))) for _ in range(30)]
        made += [" ".join(chosen.choices(["the", "\nThe", "\n-", "\n\n-", "end.", "x" * 150, "don't"], k=20)) for _ in range(9)]
        for text, ids in zip(made, both.all_ids(made), strict=True):
            a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
            raw = " ".encode() + text.encode()
            spelt = [b"".join([of[i] for i in side]) for of, side in ((both.bytes_a, a), (both.bytes_b, b))]
            assert (ids is None) == (spelt != [raw, raw]), repr(text)
            if ids is not None:
                assert [list(array("I", side)) for side in ids] == [a, b], repr(text)


def test_long_texts_and_batches(spark):
    long = " ".join(["word", "étranger", "1234", "end.\n"] * 20_000)
    assert list(alignment.batches([None, "a", "", long * 4, "b", "c"])) == [[1], [3], [4, 5]]
    table = spark.createDataFrame([(1, long), (2, "x" * 20_000)], "doc_id long, text string")
    rows = alignment.agreement(alignment.aligned(table, A, MODEL), MODEL).orderBy("doc_id").collect()
    library = Tokenizer.from_file(A)
    assert [r.n_a for r in rows] == [len(library.encode(" " + t, add_special_tokens=False).ids) for t in (long, "x" * 20_000)]
    assert all(r.groups.count(";") + 1 == r.n_groups for r in rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.agreement(alignment.aligned(empty, A, MODEL), MODEL).collect() == []
