import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_tokens import SPECIAL, WORDS, texts
from tokenizers import Tokenizer

from showpulse.llm import chunks, packing, queries

SCHEMA = "doc_id long, ids binary, loss binary, start string"


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def examples(seed=1, most=60, rows=300):
    chosen = random.Random(seed)
    made = []
    for i in range(rows):
        n = chosen.choice([0, 1, 2, chosen.randrange(1, most), chosen.randrange(1, 5 * most)])
        mask = None if i % 3 else bytes(chosen.choices([0, 1], k=n))
        made.append((i, as_bytes(range(i, i + n)) if n or i % 2 else None, mask, "own"))
    return made + made[:40]


def check(rows, made, limits, whole=False):
    """Every id lies in one piece, sequences keep the limits and have no gap; gives the sequences' lengths."""
    of, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        of[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    masks = {}
    for i, ids, mask, _ in made:
        n = len(ids or b"") // 4
        masks[i] = np.frombuffer(mask, np.uint8) if mask is not None else np.ones(n, np.uint8)
        copies = sum(1 for other in made if other[0] == i)
        pieces = sorted(of[i], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == n * copies
        assert all(bytes(r.ids) == ids[4 * r.start : 4 * (r.start + r.length)] for r in pieces)
        assert all(r.example_tokens == n for r in pieces)
        covered = np.zeros(n, int)
        for r in pieces:
            covered[r.start : r.start + r.length] += 1
        assert (covered == copies).all()
    lengths = []
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in pieces])
        assert [r.offset for r in pieces] == [0, *ends[:-1]]
        loss = sum(int(masks[r.doc_id][r.start : r.start + r.length].sum()) for r in pieces)
        assert ends[-1] <= limits.tokens and len(pieces) <= limits.segments and loss <= limits.loss
        lengths.append(int(ends[-1]))
        if not whole:
            assert ends[-1] == limits.tokens or ends[-1] & (ends[-1] - 1) == 0
    return lengths


@pytest.mark.parametrize("limits", [packing.Limits(64, 8, 64), packing.Limits(64, 3, 20), packing.Limits(50, 100, 50)])
def test_pieces_and_limits(spark, limits):
    made = examples()
    table = spark.createDataFrame(made, SCHEMA).coalesce(2)
    result = packing.packed(table, limits, loss="loss")
    assert result.columns == ["doc_id", "start", "length", "example_tokens", "sequence_id", "offset", "ids"]
    check(result.collect(), made, limits)


def test_whole_examples_are_cut_only_beyond_a_limit(spark):
    made, limits = examples(2, most=20), packing.Limits(64, 8, 40)
    rows = packing.packed(spark.createDataFrame(made, SCHEMA).coalesce(1), limits, loss="loss", whole=True).collect()
    lengths = check(rows, made, limits, whole=True)
    masks = {i: (int(np.frombuffer(m, np.uint8).sum()) if m is not None else len(ids or b"") // 4) for i, ids, m, _ in made}
    cut = {r.doc_id for r in rows if r.length < r.example_tokens}
    assert all(masks[i] > limits.loss or len(made[i][1]) // 4 > limits.tokens for i in cut)
    # First fit over the same examples, in their order, with what is beyond a limit left out: hardly fewer sequences.
    bins = []
    for i, ids, _, _ in made:
        n, m = len(ids or b"") // 4, masks[i]
        if 0 < n <= limits.tokens and m <= limits.loss:
            fit = next((b for b in bins if b[0] >= n and b[1] >= 1 and b[2] >= m), None)
            if fit is None:
                bins.append(fit := [limits.tokens, limits.segments, limits.loss])
            for d, x in enumerate((n, 1, m)):
                fit[d] -= x
    beyond = sum(len(ids or b"") // 4 for i, ids, _, _ in made if i in cut)
    assert len(lengths) <= 1.1 * (len(bins) + beyond / min(limits.tokens, limits.loss))


def test_the_open_sequence_takes_the_greatest_dot_product():
    limits = packing.Limits(10, 4, 10)
    pool = packing.Pool(limits)

    def add(n, loss):
        running = np.append(0, np.cumsum([1] * loss + [0] * (n - loss)))
        pool.add(packing.Example((n, loss), memoryview(bytes(4 * n)), running, 0, n))

    for n, loss in ((3, 3), (6, 0), (5, 5), (2, 0)):
        add(n, loss)
    left = np.array([10.0, 4.0, 1.0])
    by_hand = max(((3, 3), (6, 0), (5, 5), (2, 0)), key=lambda d: d[0] * 10 / 100 + 4 / 16 + d[1] * 1 / 100)
    assert pool.take(left, fits=False).row == by_hand == (6, 0)
    assert pool.take(left, fits=True).row == (2, 0)  # of those within one loss-bearing token
    assert pool.take(left, fits=True) is None


def test_few_tokens_and_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.packed(empty).collect() == []
    one = spark.createDataFrame([(5, as_bytes([7] * 13), None, "x"), (6, b"", None, "x"), (7, None, None, "x")], SCHEMA).coalesce(1)
    rows = packing.packed(one).collect()
    assert sorted(r.length for r in rows) == [1, 4, 8] and {r.doc_id for r in rows} == {5}
    with pytest.raises(ValueError):
        packing.packed(one, packing.Limits(0, 1, 1))


def test_ids_equal_the_library(spark):
    library = Tokenizer.from_file(WORDS)
    chosen = random.Random(8)
    letters = "abcXYZÀÉßſŸŒžİŉª²×÷'\"<|>.,09́ \n\t"
    some = texts() + ["".join(chosen.choices(letters, k=chosen.randrange(40))) for _ in range(2_000)] + [chr(c) + "a" for c in range(0x250)]
    some += ["x" * 500_000, "ab c\n" * 300_000]
    table = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    rows = chunks.tokenized(table, WORDS, end=2).orderBy("doc_id").collect()
    for row, text in zip(rows, some, strict=True):
        assert bytes(row.ids) == as_bytes([*library.encode(text or "", add_special_tokens=False).ids, 2])


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(chunks, "MEMORY", 3_000)
    memory = chunks.Memory(str.encode)
    for i in range(500):
        pieces = [f"p{i}", "often", f"p{i}", "long" * 99]
        assert [memory[p] for p in pieces] == [p.encode() for p in pieces]
        assert len(memory) + len(memory.old) < 40
    assert "often" in memory or "often" in memory.old


def test_digests_of_the_query(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {
        r.doc_id: as_bytes([*library.encode(r.text or "", add_special_tokens=False).ids, 2])
        for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    }
    rows = queries.op13_packing(spark, sf_dir).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(x) // 4 for i, x in ids.items()}
    assert sum(r.length for r in rows) == sum(len(x) // 4 for x in ids.values())
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)])
    assert SPECIAL  # the texts above hold every special case of the tokenizers' own tests
