import math
from collections import Counter

import numpy as np

from showpulse.llm import language
from showpulse.llm.queries import op2_language

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, lang_pred int, rejected string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, 1, "x") for i, t, g in rows], SCHEMA)


def test_held_out_texts(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    rows = op2_language(spark, SF).join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    judged = [r for r in rows if r.held_out and r.lang is not None and language.words(r.text)]
    assert len(judged) > 200
    assert np.mean([r.lang == r.lang_pred for r in judged]) > 0.95
    learned = {r.lang for r in rows if not r.held_out} - {None}
    assert all(0 <= r.score <= 1 and r.lang_pred in learned | {"und"} for r in rows)


def test_models_are_distributions():
    """After any context the probabilities of all characters, one unseen among them, add up to one."""
    counted = Counter({"banana": 3, "bandana": 1, "anna": 2, "a": 1, "é": 1})
    model = language.train(language.ngram_counts(counted))
    letters = sorted(set("".join(counted))) + [language.BORDER, "z"]
    for context in ("", "b", "ba", "ban", "bana", "banan", "q", "zz"):
        bits = [_last(model, context, c) for c in letters]
        assert math.isclose(sum(2.0**-b for b in bits), 1, abs_tol=1e-9)


def _last(model, context, letter):
    """Bits of `letter` after `context` at the begin of a word, from the arrays alone."""
    padded = language.BORDER + context + letter
    weight = 0.0
    for order in range(min(language.ORDER, len(padded)), 0, -1):
        gram = language.hashes([padded[-order:]])
        at, hit = language._found(model.grams[order - 1], gram)
        if hit[0]:
            return -(weight + model.logs[order - 1][at[0]]) / math.log(2)
        at, known = language._found(model.contexts[order - 1], language.hashes([padded[-order:-1]]))
        if order > 1 and known[0]:
            weight += model.leftovers[order - 1][at[0]]
    return -(weight + model.floor) / math.log(2)


def test_bits_of_words_add_up_character_by_character():
    counted = Counter({"banana": 3, "bandana": 1, "anna": 2})
    model = language.train(language.ngram_counts(counted))
    batch = ["banana", "z", "anbandanna"]
    want = [sum(_last(model, w[:i], c) for i, c in enumerate(w + language.BORDER)) for w in batch]
    assert np.allclose(language.losses([model], batch)[:, 0], want)


def test_odd_rows(spark):
    """Texts without a letter, long ones, repeated rows and columns named as the outputs."""
    rows = [(i, f"the quick brown fox number {i} runs over the hill", "en") for i in range(40)]
    rows += [(i, f"der schnelle braune fuchs {i} springt über den zaun", "de") for i in range(40, 80)]
    odd = [(100, None, "en"), (101, "", None), (102, "12 34 ?!", "de"), (103, "über den zaun " * 20_000, None)]
    odd += [(104, "THE HILL", None), (None, "over the hill", "en"), (0, rows[0][1], "en")]
    identifier = language.fit(frame(spark, rows + odd))
    got = language.identified(frame(spark, rows + odd).drop("lang"), identifier)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "rejected"]
    by_id = {r.doc_id: r for r in got.collect()}
    assert got.count() == 87
    for i in (100, 101, 102):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert [by_id[i].lang_pred for i in (103, 104, None, 0, 50)] == ["de", "en", "en", "en", "de"]


def test_a_strange_language_is_rejected(spark):
    rows = [(i, f"the quick brown fox number {i} runs over the hill with a hat", "en") for i in range(200)]
    identifier = language.fit(frame(spark, rows))
    got = language.identified(frame(spark, [(1, "xqzv wrtp kjj qqx zzv", None), (2, rows[0][1], None)]), identifier)
    assert {r.doc_id: r.rejected for r in got.collect()} == {1: True, 2: False}


def test_nothing_to_learn_from(spark):
    rows = frame(spark, [(1, "a word", None)])
    got = language.identified(rows, language.fit(rows)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    empty = frame(spark, [])
    assert language.identified(empty, language.fit(rows)).count() == 0
