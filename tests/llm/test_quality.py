import math

import numpy as np

from showpulse.llm import quality
from showpulse.llm.queries import op3_quality

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, predicted string, label string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_held_out_texts_are_ranked_right(spark):
    scored = op3_quality(spark, SF).where("held_out")
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("quality", "score", "predicted").collect()
    good, bad = (np.array([r.score for r in rows if r.quality == x]) for x in (1, 0))
    assert len(good) > 20 and len(bad) > 3
    wins = (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()
    assert wins > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_every_document_has_one_score(spark):
    rows = op3_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_pairs_teach_the_order():
    drawn = np.random.default_rng(5)
    good, bad = (np.abs(drawn.normal(m, 1, (300, quality.FEATURES))) for m in (3, 1))
    ranker = quality.preferred(good[:200], bad[:200])
    assert (ranker.raw(good[200:])[:, None] > ranker.raw(bad[200:])).mean() > 0.99


def test_weights_are_those_of_the_least_loss(monkeypatch):
    """Pair by pair in plain Python: the loss rises in every direction from the weights that were found."""
    monkeypatch.setattr(quality, "PAIRS", 60)
    drawn = np.random.default_rng(15)
    good, bad = (np.abs(drawn.normal(m, 1, (30, quality.FEATURES))) for m in (1.5, 1))
    ranker = quality.preferred(good, bad)
    again = np.random.default_rng(1)  # the pairs that it drew
    first, second = again.integers(0, len(good), 60).tolist(), again.integers(0, len(bad), 60).tolist()

    def measured(row):
        values = [*row, *(math.sqrt(abs(x)) for x in row)]
        return [min(6.0, max(-6.0, (x - m) / s)) for x, m, s in zip(values, ranker.mean, ranker.scale)]

    pairs = [(measured(good[i]), measured(bad[j])) for i, j in zip(first, second)]

    def loss(weights):
        total = 0.0
        for better, worse in pairs:
            margin = sum(w * (x - y) for w, x, y in zip(weights, better, worse))
            total += math.log1p(math.exp(-margin))
        return total / len(pairs) + quality.PENALTY / 2 * sum(w * w for w in weights)

    least = loss(ranker.weights)
    for k in range(len(ranker.weights)):
        for step in (-1e-3, 1e-3):
            other = ranker.weights.copy()
            other[k] += step
            assert loss(other) > least


def test_threshold_is_the_quantile_of_scores():
    drawn = np.random.default_rng(6)
    good, bad = (np.abs(drawn.normal(m, 1, (400, quality.FEATURES))) for m in (2, 1))
    ranker = quality.calibrate(quality.preferred(good, bad), good, bad, 0.25)
    raw = np.concatenate([ranker.raw(good), ranker.raw(bad)])
    weight = np.repeat([0.75 / 400, 0.25 / 400], 400)
    assert abs(weight[raw < ranker.threshold].sum() - 0.25) < 0.005
    scores = np.concatenate([ranker.scores(good), ranker.scores(bad)])
    assert ((scores >= quality.KEEP_FROM) == (raw >= ranker.threshold)).all()


def test_odd_rows(spark):
    """Null, empty and long texts, repeated rows, and columns named as the outputs."""
    prose = "The old bridge was closed for a week while the river rose. People went round by the mill."
    rows = [(i, f"{prose} {i}") for i in range(40)] + [(i, "$$ ## || " * 9 + str(i)) for i in range(40, 60)]
    known = [(i, int(i < 40)) for i in range(60)] + [(None, 1), (3, None), (999, 0)]
    odd = [(100, None), (101, ""), (102, prose * 3_000), (103, " \n"), (None, prose), (0, rows[0][1])]
    ranker = quality.fit(frame(spark, rows + odd), labels(spark, known))
    got = quality.scored(frame(spark, rows + odd), ranker)
    assert got.columns == ["doc_id", "text", "label", "score", "predicted"]
    out = got.collect()
    assert len(out) == 66 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 0}) == 1
    by_id = {r.doc_id: r.predicted for r in out}
    assert by_id[0] == 1 and by_id[None] == 1 and by_id[50] == 0
    assert len({r.score for r in out if r.doc_id in (100, 101)}) == 1


def test_nothing_to_prefer(spark):
    rows = frame(spark, [(1, "a b"), (2, None)])
    for known in ([], [(1, 1)], [(5, 0)]):
        ranker = quality.fit(rows, labels(spark, known))
        assert {r.score for r in quality.scored(rows, ranker).collect()} == {0.5}
    assert quality.scored(frame(spark, []), quality.fit(frame(spark, []), labels(spark, [(1, 1), (2, 0)]))).count() == 0


def test_every_labelled_text_counts(spark):
    """Mean, weights, threshold and slope by brute force over all pairs of 1,700 good and 1,600 bad texts."""
    drawn = np.random.default_rng(8)
    vocabulary = np.array(["river", "old", "mill", "Road.", "$$", "##", "a|b", "7", "Why?", "no,"])
    share = {1: np.repeat([0.14, 0.05], [6, 4]), 0: np.repeat([0.08, 0.13], [6, 4])}
    known = [(i, int(i < 1_700)) for i in range(3_300)]
    rows = [(i, " ".join(drawn.choice(vocabulary, drawn.integers(5, 40), p=share[x] / share[x].sum()))) for i, x in known]
    ranker = quality.fit(frame(spark, rows + rows[:9]), labels(spark, known))
    good, bad = (np.array([quality.features(t) for (_, t), (_, x) in zip(rows, known) if x == y]) for y in (1, 0))
    both = quality.expanded(np.vstack([good, bad]))
    assert np.allclose(ranker.mean, both.mean(0)) and np.allclose(ranker.scale, np.maximum(both.std(0), 1e-6))
    x, y = (np.clip((quality.expanded(z) - ranker.mean) / ranker.scale, -6, 6) for z in (good, bad))
    wrong = 1 / (1 + np.exp((x @ ranker.weights)[:, None] - y @ ranker.weights))
    gradient = -(wrong.sum(1) @ x - wrong.sum(0) @ y) / wrong.size + quality.PENALTY * ranker.weights
    assert np.abs(gradient).max() < 1e-4
    alone = quality.calibrate(quality.Ranker(ranker.mean, ranker.scale, ranker.weights), good, bad, 1_600 / 3_300)
    assert abs(ranker.threshold - alone.threshold) < 1e-9 and ranker.slope == alone.slope


def test_quantile_of_equal_scores(spark, monkeypatch):
    """The row at which the weights reach the share, and the next, for every share of a few rows with repeats."""
    monkeypatch.setattr(quality, "CELLS", 3)
    made = [(0, -2.0), (1, -2.0), (0, 0.5), (0, 0.5), (1, 0.5), (1, 0.5 + 1e-12), (0, 7.0), (1, 1e9)]
    scores = spark.createDataFrame(made, "label int, raw double").coalesce(1).cache()
    weight = {1: 0.2, 0: 0.05}
    ordered = sorted(made, key=lambda r: (r[1], -r[0]))
    for share in (0.1, 0.22, 0.3, 0.5, 0.75, 0.99):
        at = next(i for i in range(8) if sum(weight[c] for c, _ in ordered[: i + 1]) >= share)
        assert quality.quantile(scores, weight, share) == (ordered[at][1], ordered[min(at + 1, 7)][1])
