import functools
import math
import random
from collections import Counter

import numpy as np
import pytest

from showpulse.llm import domain
from showpulse.llm.queries import op8_domain_scores

ROWS = [
    (1, "the cat sat. The cat ran", True),
    (2, "a dog sat on the mat", False),
    (3, "the dog", False),
    (4, None, True),
    (5, "", False),
    (6, "...", None),
    (7, "zebra " * 3_000, None),
    (8, "the cat", True),
    (8, "the cat", True),
]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, g, 0.5) for i, t, g in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, target boolean, score double")


def brute_force(least_word, least_pair):
    """Scores by the definition, with words and bigrams counted in the whole table."""
    texts = [(domain.words(t), bool(g)) for _, t, g in ROWS]
    count = Counter(w for t, _ in texts for w in t)
    known = {w for w, n in count.items() if n >= least_word}
    texts = [([w if w in known else "?" for w in t], g) for t, g in texts]
    kept = {p for p, n in Counter(p for t, _ in texts for p in zip(["<"] + t, t)).items() if n >= least_pair}
    losses = []
    for only in (True, False):
        some = [t for t, g in texts if g or not only]
        single, pairs = Counter(w for t in some for w in t), Counter(p for t in some for p in zip(["<"] + t, t))
        context, size = Counter(p[0] for t in some for p in zip(["<"] + t, t)), len(known) + 1

        def loss(a, b, single=single, pairs=pairs, context=context, size=size):
            backed = (single[b] + domain.ADDED) / (sum(single.values()) + domain.ADDED * size)
            if not context[a]:
                return -math.log(backed)
            used = {p: max(n - domain.DISCOUNT, 0) for p, n in pairs.items() if p in kept and p[0] == a}
            return -math.log(used.get((a, b), 0) / context[a] + max(1 - sum(used.values()) / context[a], 1e-9) * backed)

        losses.append([sum(loss(a, b) for a, b in zip(["<"] + t, t)) / max(len(t), 1) for t, _ in texts])
    return [b - t for t, b in zip(*losses, strict=True)]


@pytest.mark.parametrize("shares", [(1e-9, 1e-9), (4e-4, 1e-3), (2e-3, 0.9)])
def test_scores_equal_the_definition(table, shares, monkeypatch):
    monkeypatch.setattr(domain, "WORD_SHARE", shares[0])
    monkeypatch.setattr(domain, "PAIR_SHARE", shares[1])
    n = sum(len(domain.words(t)) for _, t, _ in ROWS)
    want = brute_force(*(max(1.0, s * n) for s in shares))
    result = domain.scored(table, domain.fit(table, "text", "target"))
    assert result.columns == ["doc_id", "text", "target", "n_words", "target_loss", "background_loss", "score"]
    got = sorted((r.doc_id, r.n_words, round(r.score, 9)) for r in result.collect())
    assert got == sorted((i, len(domain.words(t)), round(s, 9)) for (i, t, _), s in zip(ROWS, want, strict=True))


def test_probabilities_after_each_context_add_up_to_one(table):
    import numpy as np

    scorer = domain.fit(table, "text", "target")
    size = scorer.vocabulary.size
    for model in (scorer.target, scorer.background):
        for before in range(size + 1):
            pairs = before * size + np.arange(size)
            at = np.minimum(np.searchsorted(scorer.codes, pairs), len(scorer.codes) - 1)
            loss = model.losses(np.arange(size), at, scorer.codes[at] == pairs, np.full(size, before))
            assert abs(np.exp(-loss).sum() - 1) < 1e-6


def test_empty_table(table):
    empty = table.limit(0)
    assert domain.scored(empty, domain.fit(empty, "text", "target")).count() == 0
    assert {r.score for r in domain.scored(table, domain.fit(empty, "text", "target")).collect()} == {0.0}


def test_every_good_text_is_in_the_target(spark, tmp_path):
    """6,000 good texts, each with a word of its own in the count of the target, among odd keys and labels."""
    docs = [(i, f"the {'cat' if i % 3 else 'dog'} sat {i % 50} times") for i in range(6_500)]
    docs += [(None, "the null sat"), (None, "the null ran"), (3, "the cat again"), (3, None), (9_999, "no label")]
    known = [(i, int(i < 6_000)) for i in range(6_500)] + [(4, 1), (5, 0), (None, 1), (7_777, 1), (9_999, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(known, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op8_domain_scores(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "target_loss", "background_loss", "score"]
    marked = [(i, t, i is not None and i < 6_000) for i, t in docs]
    rows = spark.createDataFrame(marked, "doc_id long, text string, target boolean")
    want = domain.scored(rows, domain.fit(rows, "text", "target")).drop("text", "target")

    def listed(df):
        return sorted((-1 if r[0] is None else r[0], r[1], *(round(x, 9) for x in r[2:])) for r in df.collect())

    assert listed(got) == listed(want)


def definition(learned, asked):
    """Words, target loss and background loss of each asked text, by counts of all words and bigrams of the learned rows."""
    learned = [(domain.words(t), bool(g)) for _, t, g in learned]
    size = len({w for t, _ in learned for w in t}) + 1
    losses = []
    for only in (True, False):
        some = [t for t, g in learned if g or not only]
        single, pairs = Counter(w for t in some for w in t), Counter(p for t in some for p in zip(["<"] + t, t))
        context, taken, n = Counter(), Counter(), sum(single.values())
        for (a, _), often in pairs.items():
            context[a] += often
            taken[a] += often - domain.DISCOUNT

        def loss(a, b, single=single, pairs=pairs, context=context, taken=taken, n=n):
            backed = (single[b] + domain.ADDED) / (n + domain.ADDED * size)
            if not context[a]:
                return -math.log(backed)
            kept = max(pairs[a, b] - domain.DISCOUNT, 0) / context[a]
            return -math.log(kept + max(1 - taken[a] / context[a], 1e-9) * backed)

        loss = functools.cache(loss)
        texts = [domain.words(t) for _, t, _ in asked]
        losses.append([math.fsum(loss(a, b) for a, b in zip(["<"] + t, t)) / max(len(t), 1) for t in texts])
    counts = [len(domain.words(t)) for _, t, _ in asked]
    made = zip((i for i, _, _ in asked), counts, *losses, strict=True)
    return sorted((i, n, round(t, 8), round(b, 8), round(b - t, 8)) for i, n, t, b in made)


def found(df):
    columns = "doc_id", "n_words", "target_loss", "background_loss", "score"
    return sorted((*r[:2], *(round(x, 8) for x in r[2:])) for r in df.select(*columns).collect())


def framed(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, target boolean").repartition(3)


def test_rare_words_and_pairs_count_in_a_large_table(spark):
    """Among 800,000 words a word or bigram that occurs once or twice is in the models as well."""
    rows = [(i, "the cat " * 200_000, False) for i in range(2)]
    rows += [(2, "the zygote sat", True), (3, "the zygote sat", True)]
    rows += [(4, "sat quark the", False), (5, "once only here", True)]
    table = framed(spark, rows)
    want = definition(rows, rows)
    assert found(domain.scored_among(table, "text", "target")) == want
    assert found(domain.scored(table, domain.fit(table, "text", "target"))) == want


def test_many_chunks_and_buckets(spark, monkeypatch):
    """Chunks of some texts, few words a bucket, one bigram in every text and contexts spread over buckets."""
    for name, value in {"CHUNK": 200, "ROWS": 4, "WORD_BUCKETS": 7, "FEW_BUCKETS": 40, "SMALL_BUCKET": 100}.items():
        monkeypatch.setattr(domain, name, value)
    pick = random.Random(5)
    names = [f"w{i}" for i in range(300)]
    often = [1 / (i + 1) for i in range(300)]
    rows = []
    for i in range(400):
        text = " ".join(pick.choices(names, often, k=pick.randrange(0, 30))) + (" hot pair hot pair" if i % 9 else "")
        rows.append((i, text, pick.choice([True, False, None])))
    rows += [(400, None, True), (401, "...", False), (7, rows[7][1], True), (7, rows[7][1], True)]
    table = framed(spark, rows)
    assert found(domain.scored_among(table, "text", "target")) == definition(rows, rows)
    others = [(i, f"w{i} w1 unseen w2 w{i} hot hot", None) for i in range(60)]
    got = domain.scored(framed(spark, others), domain.fit(table, "text", "target"))
    assert found(got) == definition(rows, others)


def test_packed_arrays():
    arrays = [np.array(x, np.int64) for x in ([], [0, 0], [1, 255], [256, 0, 2**40], [2**62])]
    assert [a.tolist() for a in domain._unpacked(domain._packed(*arrays))] == [a.tolist() for a in arrays]
