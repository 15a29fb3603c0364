import random
from collections import Counter

import numpy as np
import pytest

from showpulse.llm import components, setjoin


def brute_force(rows):
    """class_id, n_links and n_copies by key, from all pairs of texts."""
    texts = {t for _, t in rows if t is not None}
    sets = {}
    for t in texts:
        w = t.lower().split()
        sets[t] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    near = {t: {u for u in texts if u != t and sets[t] and 5 * len(sets[t] & sets[u]) >= 4 * len(sets[t] | sets[u])} for t in texts}
    copies = Counter(t for _, t in rows)
    out = {}
    for key, t in rows:
        if t is None:
            out[key] = (key, 0, 1)
            continue
        seen, front = {t}, [t]
        while front:
            front = [u for v in front for u in near[v] if u not in seen and not seen.add(u)]
        out[key] = (min(k for k, u in rows if u in seen), len(near[t]), copies[t])
    return out


def corpus():
    chosen = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    prose = lambda n: [chosen.choice(words) for _ in range(n)]
    texts = [" ".join(prose(chosen.randrange(3, 90))) for _ in range(250)]
    passage = " ".join(prose(30))
    texts += [passage + " " + " ".join(prose(40)) for _ in range(60)]  # unlike texts that share a passage
    hot = prose(120)
    for i in range(700):  # one large group of near copies
        texts.append(" ".join(hot[:60] + [f"x{i}"] + hot[61:]))
    for _ in range(150):
        near = chosen.choice(texts[:250]).split()
        for _ in range(chosen.randrange(4)):
            near[chosen.randrange(len(near))] = chosen.choice(words)
        texts.append(" ".join(near))
    texts += chosen.choices(texts, k=200) + ["", "", " ", "a", "A", "a b", "w1 w2 w3 w4", None, None, "\n", "word " * 5_000]
    chosen.shuffle(texts)
    return list(enumerate(texts))


def test_classes_and_links_equal_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, class_id string, size int")
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in setjoin.near_copies(table).collect()}
    assert got == brute_force(rows)


def test_one_of_each_class_stays_with_its_columns(spark):
    rows = corpus()
    table = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, class_id string, size int")
    kept = setjoin.first_of_each(table)
    assert sorted(kept.columns) == sorted(table.columns)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _, _ in brute_force(rows).values()})


def test_whole_table_equals_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in setjoin.near_copies(table).collect()}
    assert got == brute_force([(r.doc_id, r.text) for r in table.collect()])


def test_null_and_repeated_keys(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "x y"), (None, None), (2, "X  y")]
    got = setjoin.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter({(None, None): 2, (1, 1): 3, (2, 1): 1})


def test_empty_table(spark):
    assert setjoin.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_intersections():
    drawn = np.random.default_rng(3)
    sets = [np.unique(drawn.integers(0, 9_000, n).astype(np.uint64)) for n in (0, 1, 50, 6_000, 7_000)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = setjoin._overlaps(sets)
    off = ~np.eye(5, dtype=bool)
    assert (got[off] == np.array(want)[off]).all()


@pytest.mark.parametrize("n", [1, 60])
def test_components_of_chains_and_rings(spark, n):
    drawn = random.Random(n)
    nodes = drawn.sample(range(-1_000, 1_000), 3 * n + 3)
    edges = [(nodes[i], nodes[i + 1]) for i in range(3 * n) if i % (n + 1)] + [(nodes[0], nodes[0]), (nodes[1], nodes[2])]
    root = {v: v for e in edges[:-2] + edges[-1:] for v in e}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in components.components(frame).collect()} == root
