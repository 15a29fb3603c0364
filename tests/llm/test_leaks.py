import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from showpulse.llm import leaks


def plain_alignment(item, passage):
    rows = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            diagonal = rows[i - 1, j - 1] + (leaks.MATCH if a == b else leaks.MISMATCH)
            rows[i, j] = max(0, diagonal, rows[i - 1, j] + leaks.GAP, rows[i, j - 1] + leaks.GAP)
    return rows.max()


def test_alignment_equals_plain_dynamic_programming():
    drawn = np.random.default_rng(1)
    for _ in range(300):
        item, passage = drawn.integers(1, 6, drawn.integers(1, 15)), drawn.integers(0, 6, drawn.integers(1, 30))
        assert leaks.aligned(item, passage)[0] == plain_alignment(item, passage)


@pytest.fixture(scope="module")
def case(spark):
    chosen = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    prose = lambda n: [chosen.choice(words) for _ in range(n)]
    items = [prose(30) for _ in range(20)]
    rows, want = [], set()
    for key in range(400):
        text = prose(chosen.randrange(5, 200))
        if key % 4 == 0:  # a copy, whole or edited, somewhere in the text; item 0 is in a quarter of all texts
            for n in {0, chosen.randrange(20)}:
                copy = list(items[n])
                for _ in range(chosen.randrange(6)):
                    copy[chosen.randrange(len(copy))] = chosen.choice(words)
                if chosen.random() < 0.5:
                    del copy[7]
                    copy.insert(15, "new")
                text += [copy[0].upper() + ",", *copy[1:], *prose(chosen.randrange(40))]
                want.add((key, n))
        rows.append((key, " ".join(text), "x", 1))
    rows += [(400, None, "x", 1), (401, "", "x", 1), (402, "w " * 20_000 + " ".join(items[5]), "x", 1)]
    want.add((402, 5))
    table = spark.createDataFrame(rows, "doc_id long, text string, item_id string, end int")
    bench = [(n, " ".join(t)) for n, t in enumerate(items)] + [(90, None), (91, ""), (92, "w1 w2"), (None, "w1 w2 w3 w4 w5")]
    return table, spark.createDataFrame(bench, "item_id long, text string"), want


def brute_force(table, bench):
    out = set()
    for d in table.collect():
        numbers = {w: i for i, w in enumerate(sorted(set(leaks.words(d.text))), 1)}
        passage = [numbers[w] for w in leaks.words(d.text)]
        for b in bench.collect():
            own = leaks.words(b.text)
            if len(own) >= leaks.SEED and b.item_id is not None and len(passage) < 1_000:
                score, _ = leaks.aligned(np.array([numbers.get(w, -1) for w in own]), np.array(passage))
                if score >= leaks.SHARE * leaks.MATCH * len(own):
                    out.add((d.doc_id, b.item_id))
    return out


def test_copies_are_found_as_by_aligning_all_pairs(case):
    table, bench, want = case
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(table, bench).collect()}
    assert got == want
    assert {x for x in got if x[0] != 402} == brute_force(table, bench)


def test_several_blocks_give_the_same(case, monkeypatch):
    table, bench, want = case
    monkeypatch.setattr(leaks, "ITEM_WORDS", 60)
    rows = leaks.leaks(table, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert len(rows) == len(want)


def test_texts_without_leaks_stay(case):
    table, bench, want = case
    kept = leaks.without_leaks(table, bench)
    assert kept.columns == table.columns
    bad = {d for d, _ in want}
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(403) if k not in bad]


def test_repeated_rows_and_items(case):
    table, bench, want = case
    twice = leaks.leaks(table.unionAll(table), bench.unionAll(bench))
    assert sorted((r.doc_id, r.item_id) for r in twice.collect()) == sorted([*want, *want])


def test_empty_tables(case):
    table, bench, _ = case
    assert leaks.leaks(table.limit(0), bench).count() == 0
    assert leaks.leaks(table, bench.limit(0)).count() == 0
    assert leaks.without_leaks(table.where(F.col("doc_id").isNull()), bench).count() == 0
