import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from showpulse.llm import pieces, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SPECIAL = [None, "", " ", "  a  b ", "\n\n x\n", "▁▁a", "a\x00b", "<s> </s>", "<|endoftext|>a<|startoftext|>", "ΑΣ ΑΣΑ", "don't",
           "é😀 ​ ", "ab" * 20_000, "x" * 3_000, " " * 777, "�", "ꟋꟜ", "<|x|>", "1234,5"]


def texts():
    chosen = random.Random(5)
    letters = "    \n\tabcdeinth.,'|éßß😀123▁中İΣ"
    return SPECIAL + ["".join(chosen.choices(letters, k=chosen.randrange(60))) for _ in range(300)]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "a", 7) for i, t in enumerate(texts())] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, decoded string, n_tokens int")


def test_pieces_equal_the_library(table):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    result = pieces.roundtrip(table, MODEL)
    assert result.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    rows = result.collect()
    assert len(rows) == table.count()
    for row in rows:
        ids = library.encode(row.text or "", add_eos=True)
        assert row.ids == ids
        assert row.decoded == library.decode(ids)


def test_merging_by_backtracking_equals_plain_merging():
    vocabulary = pieces.Pieces(MODEL)
    encoder, chosen = pieces.Encoder(vocabulary), random.Random(6)
    for _ in range(3_000):
        chunk = "▁" * chosen.randrange(5) + "".join(chosen.choices("abcdehinorstz▁é中", k=chosen.randrange(1, 25)))
        assert encoder.tokens(chunk) == vocabulary.merge(chunk)


def test_decoding_any_ids_equals_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    decode, chosen = pieces.decoder(pieces.Pieces(MODEL)), random.Random(7)
    some = [0, 1, 2, 229, 153, 132, 68, 258, 243, 259, 260, 28705, 264, 162, 198]
    for _ in range(5_000):
        ids = chosen.choices(some, k=chosen.randrange(9))
        assert decode(ids) == library.decode(ids)


def test_counts_equal_the_library(table):
    library = Tokenizer.from_file(WORDS)
    result = token_counts.token_counts(table, WORDS, limit=9)
    assert result.columns == ["doc_id", "text", "decoded", "n_bytes", "n_tokens", "over_limit"]
    for row in result.collect():
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((row.text or "").encode()), n, n > 9)


def test_whole_strings_are_single_tokens():
    library, vocabulary = Tokenizer.from_file(WORDS), token_counts.Vocabulary(WORDS)
    words = sorted(vocabulary.whole)
    assert all(vocabulary.count(w) == 1 for w in words)
    sure = [w for w in words if w.isalpha() and w.isascii()]
    assert {len(e.ids) for e in library.encode_batch(sure, add_special_tokens=False)} == {1}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.roundtrip(empty, MODEL).count() == 0
    assert token_counts.token_counts(empty, WORDS).count() == 0


def test_digests_of_the_queries(spark, sf_dir):
    import __spark_entry__ as driver

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = driver.queries()["op1_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    counts = driver.queries()["op10_token_counts"](spark, sf_dir).collect()
    other = Tokenizer.from_file(WORDS)
    assert {r.doc_id: r.n_tokens for r in counts} == {
        i: len(other.encode(t, add_special_tokens=False).ids) for i, t in texts.items()
    }
