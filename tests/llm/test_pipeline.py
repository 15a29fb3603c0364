"""The pipeline stage by stage, each against a plain form of what it decides."""

import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_leaks import brute_force as leaking
from test_setjoin import brute_force as copied
from test_tokens import MODEL

import corpus_pipeline
from showpulse.llm import personal, quality, sampling, setjoin


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before the first stage and after each, with nulls and odd rows among them."""
    sf_dir, folder = "/root/testdata/sf0.01", tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 2 = 0")
    odd = [(-1, None, None, None, None), (-2, "", "en", "s", 0), (None, "no key 1.2.3.4", "en", None, 14), (-4, "x " * 30_000, "en", "s", 60_000)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    made = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, made[-1], sf_dir).write.parquet(f"{folder}/{n}")
        made.append(spark.read.parquet(f"{folder}/{n}"))
    return sf_dir, made


def test_columns_stay(stages):
    _, made = stages
    assert all(sorted(x.columns) == sorted(made[0].columns) for x in made[1:-1])
    assert all(x.schema[f.name].dataType == f.dataType for x in made[1:-1] for f in made[0].schema)


def test_quality_keeps_what_the_ranker_accepts(spark, stages):
    sf_dir, made = stages
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ranker = quality.fit(made[0], labels.where(sampling.remainder("doc_id", 5) != 0))
    want = [r.doc_id for r in made[0].collect() if ranker.scores(quality.np.array([quality.features(r.text)]))[0] >= 0.3]
    kept = [r.doc_id for r in made[1].collect()]
    assert sorted(kept, key=str) == sorted(want, key=str)
    judged = made[0].join(labels, "doc_id").withColumn("kept", F.col("doc_id").isin([k for k in kept if k is not None]))
    share = {r.quality: r.s for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert share[1] > 0.97
    assert share[0] < 0.03


def test_one_of_each_class_of_near_copies_stays(stages):
    _, made = stages
    rows = [(r.doc_id, r.text) for r in made[1].collect()]
    classes = copied([x for x in rows if x[0] is not None])
    want = {c for c, _, _ in classes.values()} | ({None} if (None in dict(rows)) else set())
    assert {r.doc_id for r in made[2].collect()} == want
    assert made[2].count() == len(want)


def test_benchmark_items_go(spark, stages):
    sf_dir, made = stages
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    short = made[2].where("length(text) < 3000 AND doc_id IS NOT NULL")
    bad = {d for d, _ in leaking(short, items)}
    kept = {r.doc_id for r in made[3].collect()}
    before = {r.doc_id for r in short.collect()}
    assert kept & before == before - bad
    assert kept <= {r.doc_id for r in made[2].collect()}


def test_no_personal_data_is_left(stages):
    _, made = stages
    before = {r.doc_id: r for r in made[3].collect()}
    for r in made[4].collect():
        assert not personal.matches(r.text or "")
        assert r.n_chars == (None if r.text is None else len(r.text))
        old = before.pop(r.doc_id)
        assert (r.lang, r.source) == (old.lang, old.source)
        if not any(c.isdigit() or c == "@" for c in old.text or ""):
            assert r.text == old.text
    assert not before


def test_tokens_are_those_of_the_library(stages):
    _, made = stages
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in made[4].collect()}
    rows = made[5].collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id], add_eos=True)
        assert r.n_tokens == len(r.ids)


def test_run_is_the_stages_in_turn(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows
    assert len({r.doc_id for r in rows}) == len(rows)


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, personal string, "
CLASHING += "ids string, decoded string, class_id string, item_id int, own_columns int, key string, row long, _row string"


def test_own_columns_survive_every_stage(spark, stages):
    """Columns named like those that operators add keep their names, types and values."""
    sf_dir, made = stages
    some = made[0].where("length(text) < 2000").limit(80).selectExpr(
        "*", "'s' AS score", "'p' AS predicted", "'q' AS personal", "'i' AS ids", "'d' AS decoded", "'c' AS class_id",
        "7 AS item_id", "8 AS own_columns", "'k' AS key", "9L AS row", "'r' AS _row",
    )
    docs = spark.createDataFrame(some.collect(), CLASHING)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in docs.schema]
        rows = kept.collect()
        assert rows and {tuple(r)[5:] for r in rows} == {("s", "p", "q", "i", "d", "c", 7, 8, "k", 9, "r")}
    assert corpus_pipeline.tokens(spark, docs, sf_dir).count() == 80


def test_empty_tables(spark, stages):
    sf_dir, made = stages
    empty = made[0].limit(0)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, empty, sf_dir)
        assert kept.count() == 0 and (n == 4 or kept.columns == empty.columns)


def test_repeated_rows_and_shared_keys(spark, stages):
    """Of rows equal in key and text one stays; of texts that share a key and a class with others, one."""
    sf_dir, _ = stages
    a, b, c, d = ("".join(f"{w}{i} " for i in range(30)) for w in ("la", "su", "mi", "no"))
    rows = [(1, a), (1, a), (1, b), (0, b), (2, c), (2, c), (3, c), (4, None), (4, None), (5, None), (6, ""), (6, ""), (7, ""), (None, d), (None, d), (8, d)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.without_near_copies(spark, docs, sf_dir)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (0, b), (2, c), (4, None), (5, None), (6, ""), (None, d), (None, d), (8, d)], key=str)
    for _, stage in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[2], corpus_pipeline.STAGES[3]):
        counts = stage(spark, docs, sf_dir).groupBy("doc_id", "text").count().collect()
        want = docs.groupBy("doc_id", "text").count().collect()
        assert {(r.doc_id, r["count"]) for r in counts} <= {(r.doc_id, r["count"]) for r in want}


def test_of_repeated_rows_with_other_columns_one_whole_row_stays(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text, f"l{i}", i) for i in range(6)], "doc_id long, text string, lang string, n_chars long")
    kept = [tuple(setjoin.first_of_each(docs.repartition(n)).first()) for n in (1, 3)]
    assert kept[0] == kept[1] and kept[0][2] == f"l{kept[0][3]}"
