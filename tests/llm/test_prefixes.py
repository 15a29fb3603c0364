import random

from oracle import as_bag, assert_same

import duckdb
from showpulse.llm import prefixes, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def sql_rows(rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    result = db.execute(queries._TRIE_SQL)
    return as_bag([c[0] for c in result.description], result.fetchall())


def assert_equals_sql(df, rows):
    assert as_bag(df.columns, [tuple(r) for r in df.collect()]) == sql_rows(rows)


def some_rows():
    """Few texts, so that paths share much; nulls, equal turn numbers, repeated rows, negative and missing heads."""
    chosen = random.Random(3)
    texts = [None, "", " a  b\tc\n", "a", "x y", " z"]
    rows = []
    for conv in [*range(-45, 90), 10**12, 10**12 + 7, None]:
        if conv == 40:
            continue  # a head that is missing
        for _ in range(chosen.randrange(1, 7)):
            row = (conv, chosen.choice([None, 0, 1, 2, 3, 4, 5]), chosen.choice([None, "user", "assistant"]), chosen.choice(texts))
            rows += [row] * chosen.choice([1, 1, 1, 2])
    return rows


def test_trie_equals_sql_whatever_the_shards(spark):
    rows = some_rows()
    table = spark.createDataFrame(rows, SCHEMA)
    paths = prefixes.rebuilt_paths(table)
    assert_equals_sql(prefixes.trie(paths), rows)
    for turns in (3, 11, 60):
        assert_equals_sql(prefixes.trie(paths, turns), rows)


def test_copies_of_one_conversation_are_split_over_shards(spark):
    rows = [(c, t, "user", text) for c in range(20, 520) for t, text in enumerate(["a b", "c", "d e f", "g", "h"])]
    rows += [(c, t, "user", f"{c} {t}") for c in range(600, 640) for t in range(3)]
    paths = prefixes.rebuilt_paths(spark.createDataFrame(rows, SCHEMA))
    keys = prefixes.splitters([(bytes(r.path), r.conv_id, 1) for r in paths.collect()], 8)
    assert len({path for path, _ in keys}) < len(keys) == 7  # several splitters lie among the copies
    assert_equals_sql(prefixes.trie(paths, 200), rows)


def test_long_conversations_beyond_the_depth_of_splitters(spark):
    rows = [(c, t, "user", "same" if t < 50 else f"{c % 3} {t}") for c in range(1, 19) for t in range(60 + c % 5)]
    assert_equals_sql(prefixes.trie(prefixes.rebuilt_paths(spark.createDataFrame(rows, SCHEMA)), 40), rows)


def test_empty_table_and_other_columns(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(0, 0, "user", "a"), (1, 0, "user", "b"), (1, 1, None, None)]
    wider = spark.createDataFrame([(*r, b"p", "d") for r in rows], SCHEMA + ", path binary, depth string")
    assert_equals_sql(prefixes.prefix_trie(wider), rows)


def test_conversations_left_without_turns_end_at_the_root(spark):
    rows = [(c, 0, "user", "a") for c in range(21, 40)]  # no head: those that take a turn have none left
    result = prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    assert_equals_sql(result, rows)
    assert result.where("depth = 0").first().n_convs == 19


def test_splitters_are_few_and_in_order():
    drawn = [(bytes([i // 50] * 20 + [i] * 20), i, 1) for i in range(200)]
    keys = prefixes.splitters(drawn, 10)
    assert keys == sorted(keys) and len(keys) == 9
    assert prefixes.splitters([], 5) == []


def test_query_equals_its_sql_on_the_larger_table(spark):
    assert_same(queries.op11_prefix_trie(spark, "/root/testdata/sf0.01"), queries._TRIE_SQL, "/root/testdata/sf0.01")
