"""A training corpus from raw documents: reject, deduplicate, decontaminate, redact, tokenize.

Each stage takes the session, the documents that its predecessor kept and the folder of the tables, and returns documents
with all their columns, whatever these are called; the last returns their tokens. All stages read whole texts of any length.
Rows with a null key or text pass as each stage says; an empty table gives an empty table.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showpulse.llm import leaks, personal, pieces, quality, sampling, setjoin
from showpulse.sources.shared import settled

OWN = "own_columns"


def aside(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, so that an operator's columns cannot replace them."""
    others = [F.col(f"`{name}`") for name in docs.columns if name not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_")).alias(OWN))


def back(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` from rows that came from `aside`."""
    own = [name if name in ("doc_id", "text") else F.col(OWN)[name].alias(name) for name in docs.columns]
    return kept.select(*own)


def good_enough(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold, learned from the labels of those at hand.

    A document whose score equals the threshold stays. Null and empty texts are scored as texts without words. Repeated rows are
    judged each, and alike. Without labels all documents stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(sampling.remainder("doc_id", 5) != 0)
    scored = quality.scored(aside(docs), quality.fit(docs, labels))
    return back(scored.where("predicted = 1"), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the least doc_id; see `setjoin.first_of_each` for equal keys,
    repeated rows and nulls."""
    return setjoin.first_of_each(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, whole or edited. Documents with the key of one that does go with it; those
    with a null key, and null and empty texts, stay."""
    return leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars, if there is one, follows the text. Null texts stay."""
    clean = back(personal.redacted(aside(docs), personal.fit(docs)), docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the text's ids, their number, and whether they decode to the text again. No other column of the
    documents is kept; a null text counts as empty. Repeated rows are encoded each.

    They do decode to it for every text but those that hold the model's own stand-in for a space.
    """
    encoded = pieces.roundtrip(aside(docs), public_tokenizers.path("piece_bpe_32k.model"))
    same = (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless")
    own = [F.col(OWN)[name].alias(name) for name in ("lang", "source")]
    return encoded.select("doc_id", *own, "ids", F.size("ids").cast("long").alias("n_tokens"), same)


STAGES = [
    ("quality", good_enough),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what each stage keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
