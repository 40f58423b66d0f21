"""Retrieval evaluation: corpus to chunks to answers to one report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.answering import answer_questions
from riskweave.operators.chunking import chunk_corpus
from riskweave.operators.retrieval import TOP_K, search_counts, store_counts
from riskweave.operators.reteval import evaluation_report
from riskweave.session import materialize
from riskweave.sources.corpus import read_chunk_store
from riskweave.sources.tables import write_report


def build_index(docs: DataFrame, out: str, source: str = "source", text: str = "text", order: str | None = None) -> DataFrame:
    """Chunk the corpus once and keep the chunks as a parquet table under ``out``."""
    chunks = chunk_corpus(docs, source, text, order)
    chunks.write.mode("overwrite").parquet(f"{out}/chunks")
    return docs.sparkSession.read.schema(chunks.schema).parquet(f"{out}/chunks")


def export_chunk_store(chunks: DataFrame, out: str) -> DataFrame:
    """The chunk store as JSON lines, read back."""
    write_report(chunks.select("id", "text", "source"), out, "json")
    return read_chunk_store(chunks.sparkSession, out)


def evaluate(
    questions: DataFrame, gold: DataFrame, chunks: DataFrame, out: str, k: int = TOP_K,
    retrieve: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``metric, value`` over ``questions`` (query_id, question) and ``gold`` (query_id, source)."""
    if retrieve is None:
        stored = store_counts(chunks)

        def retrieve(asked: DataFrame) -> DataFrame:
            return search_counts(asked, stored, k)

    hits = materialize(retrieve(questions.select("query_id", F.col("question").alias("query"))), "hits")
    answers = materialize(answer_questions(questions, chunks, k, retrieve=retrieve), "answers")
    report = materialize(evaluation_report(hits, gold, answers, chunks, k), "report")
    write_report(report, f"{out}/retrieval_report", "json")
    return report
