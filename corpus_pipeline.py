"""From raw documents to packed sequences, one stage after another over the whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import crc_of, table, without_ids
from riskweave.llm.exact import keep_one
from riskweave.llm.jaccard import jaccard_join
from riskweave.llm.packing import pack, tokenizer_json
from riskweave.llm.surrogates import replace_private
from riskweave.llm.toxicity import fit_toxicity, reject_toxic
from riskweave.session import materialize

#: The secret of the surrogates; a job sets its own.
SURROGATE_KEY = b"corpus pipeline"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels, learned without the held-out ones, doesn't find toxic."""
    labels = table(spark, sf_dir, "labels").filter(crc_of("doc_id") % 5 != 0)
    return reject_toxic(docs, fit_toxicity(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the one with the largest id."""
    return keep_one(docs, crc_of("doc_id") % 2, 2)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more in word 5-grams, directly or over others, the one with the least id.

    Rows that share an id with another text are documents of their own, as are rows without an id, which come last.
    """
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    key, rows = "doc_id", docs
    if n != ids:  # numbers in the order of ids and texts stand for them
        key = "_" * (1 + max(map(len, docs.columns)))  # longer than any column's name
        order = [F.col("doc_id").asc_nulls_last(), F.sha2("text", 256)]
        rows = materialize(docs.orderBy(*order).withColumn(key, F.monotonically_increasing_id()), "numbered-documents")
    gone = jaccard_join(rows, key=key).filter("doc_id <> group_id").select(F.col("doc_id").alias(key))
    return without_ids(rows, materialize(gone, "dropped-ids"), key).select(*[F.col(f"`{c}`") for c in docs.columns])


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows the text."""
    found = replace_private(docs, SURROGATE_KEY).select(docs.columns)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences of at most 4096 tokens."""
    return pack(docs, tokenizer_json())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("pii", pii),
    ("best_fit_packing", best_fit_packing),
]

#: The learned model, the surrogates and the packing have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
