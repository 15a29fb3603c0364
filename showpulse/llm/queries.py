"""The operators of this package applied to whole tables, each with its SQL where SQL can express it."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showpulse.llm import (
    alignment,
    chunks,
    domain,
    language,
    leaks,
    nearest,
    packing,
    personal,
    pieces,
    prefixes,
    quality,
    sampling,
    setjoin,
    shards,
    token_counts,
)
from showpulse.sources.shared import settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_sentencepiece(spark, sf_dir):
    texts = documents(spark, sf_dir).select("doc_id", "text")
    rows = pieces.roundtrip(texts, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_language(spark, sf_dir):
    held_out = F.coalesce(sampling.remainder("doc_id", 3) == 1, F.lit(False))
    texts = documents(spark, sf_dir).select("doc_id", "text", "lang", held_out.alias("held_out"))
    identifier = language.fit(texts.where(~F.col("held_out")))
    return language.identified(texts.drop("lang"), identifier).drop("text")


def op3_quality(spark, sf_dir):
    held_out = F.coalesce(sampling.remainder("doc_id", 5) == 0, F.lit(False))
    learned = table(spark, sf_dir, "labels").where(~held_out)
    texts = documents(spark, sf_dir).select("doc_id", "text")
    ranker = quality.fit(texts, learned)
    return quality.scored(texts.withColumn("held_out", held_out), ranker).drop("text")


def op4_shards(spark, sf_dir):
    return shards.sharded(documents(spark, sf_dir), 40)


def op5_near_copies(spark, sf_dir):
    return setjoin.near_copies(documents(spark, sf_dir))


def op6_personal_data(spark, sf_dir):
    texts = documents(spark, sf_dir).select("doc_id", "text")
    found = personal.found_in(texts, personal.fit(texts))
    base = F.filter("personal", lambda s: s["base"])
    counts = [personal.number_of(base, kind).alias(f"n_{kind}") for kind in personal.KINDS]
    digest = F.sha2(personal.listed(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, personal.listed(F.col("personal")).alias("spans"))


def op7_top_k(spark, sf_dir):
    vectors = nearest.quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest.top_k(vectors, F.col("id") % 20 == 0).drop("read_share")


def op8_domain_scores(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit(True).alias("target")).distinct()
    texts = documents(spark, sf_dir).select("doc_id", "text")
    # The labels of a large table fit no executor; rows without a key match none and would all be shuffled to one task.
    marked = texts.where("doc_id is not null").join(good.hint("merge"), "doc_id", "left")
    marked = marked.unionByName(texts.where("doc_id is null").withColumn("target", F.lit(False)))
    return domain.scored_among(marked, "text", "target")


def op9_leaks(spark, sf_dir):
    return leaks.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark, sf_dir):
    texts = documents(spark, sf_dir).select("doc_id", "text")
    counted = token_counts.token_counts(texts, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_prefix_trie(spark, sf_dir):
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_alignment(spark, sf_dir):
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = alignment.aligned(documents(spark, sf_dir).select("doc_id", "text"), a, b).drop("text")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    scored = alignment.agreement(found.select("doc_id", *counts, digest, "pairs", "times"), b)
    return scored.select("doc_id", *counts, "n_best", "count_sum", "groups_sha256")


SEQUENCE = packing.Limits(tokens=4_096, segments=256, loss=4_096)
END_ID = 2


def op13_packing(spark, sf_dir):
    texts = documents(spark, sf_dir).select("doc_id", "text")
    ids = chunks.tokenized(texts, public_tokenizers.path("word_bpe_49k.json"), END_ID).drop("text")
    return packing.packed(ids, SEQUENCE).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        F.col("example_tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


# The crc32 of a number's text, by bytes and bits.
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, len(c::VARCHAR) + 1),
        lambda i: unicode(substr(c::VARCHAR, i, 1))::UBIGINT)),
    lambda s, b: list_reduce(list_prepend(xor(s, b), list_transform(range(8), lambda i: 0::UBIGINT)),
        lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::UBIGINT) ELSE r // 2 END)), 4294967295::UBIGINT)"""

_TRIE_SQL = f"""WITH own AS (SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
taking AS (SELECT c, p, CAST({_CRC} % 4 AS BIGINT) AS h FROM own),
rebuilt AS (SELECT t.c, list_concat(coalesce(b.p[1:t.h], []), t.p[t.h + 1:]) AS p
    FROM taking t LEFT JOIN own b ON b.c = t.c - t.c % 20),
members AS (SELECT c, unnest(range(0, len(p) + 1)) AS d, p FROM rebuilt),
nodes AS (SELECT p[1:d] AS node, d, min(c) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CASE WHEN len(p) = d THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
    FROM members GROUP BY node, d),
kin AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
costs AS (SELECT n.node, n.d, coalesce(n_children, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1)
        * len(regexp_extract_all(n.node[n.d].t, '[^\x20\x09-\x0D]+')) END AS saved FROM nodes n LEFT JOIN kin USING (node)),
under AS (SELECT node[1:above] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(0, d + 1)) AS above FROM costs) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, c.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
    CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN costs c USING (node) JOIN under u USING (node) LEFT JOIN nodes p ON n.d > 0 AND p.node = n.node[1:n.d - 1]"""

# Each query with its SQL.
QUERIES = {
    "op1_sentencepiece": (op1_sentencepiece, None),
    "op2_language": (op2_language, None),
    "op3_quality": (op3_quality, None),
    "op4_shards": (op4_shards, None),
    "op5_near_copies": (op5_near_copies, None),
    "op6_personal_data": (op6_personal_data, None),
    "op7_top_k": (
        op7_top_k,
        """WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[]))
    AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored)
SELECT * FROM ranked WHERE rank <= 20""",
    ),
    "op8_domain_scores": (op8_domain_scores, None),
    "op9_leaks": (op9_leaks, None),
    "op10_token_counts": (op10_token_counts, None),
    "op11_prefix_trie": (op11_prefix_trie, _TRIE_SQL),
    "op12_alignment": (op12_alignment, None),
    "op13_packing": (op13_packing, None),
}
