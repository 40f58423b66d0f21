"""Cutting documents into overlapping chunks that end at sentence or paragraph ends."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import bounded

# Chunk geometry in characters and the pattern of an acceptable end.
CHUNK_SIZE = 800
CHUNK_OVERLAP = 150
CHUNK_END = re.compile(r"[.!?]\s|\n\n")
EXTRA_NEWLINES = re.compile(r"\n{3,}")


def chunk_limits(text: str, size: int, overlap: int, crawl: bool = False) -> Iterator[tuple[int, int]]:
    """Start and end of each chunk. All possible ends are found in one pass; each chunk then takes its last by bisection."""
    ends = [m.end() for m in CHUNK_END.finditer(text)]
    start = 0
    while len(text) - start > size:
        below = bisect_right(ends, start + size)
        end = ends[below - 1] if below and ends[below - 1] >= start + 2 else 0  # both characters lie in the chunk
        if not end and start and text[start - 1] in ".!?" and text.startswith("\n\n", start):
            end = start + 2  # a blank line whose first half ended a sentence before this chunk
        if not end or (end - start <= overlap and not crawl):
            end = start + size
        yield start, end
        start = max(end - overlap, start + 1)
    yield start, len(text)


def split_text(
    text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, crawl: bool = False
) -> list[str]:
    """Chunks of one text, without white space around; empty ones are left out."""
    cleaned = EXTRA_NEWLINES.sub("\n\n", text or "").strip()
    return [chunk for a, b in chunk_limits(cleaned, size, overlap, crawl) if (chunk := cleaned[a:b].strip())]


def chunk_corpus(
    docs: DataFrame, source: str = "source", text: str = "text", order: str | None = None,
    size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, crawl: bool = False,
) -> DataFrame:
    """``id, source, corpus_order, ordinal, text`` with id ``source::ordinal``.

    A boundary that would not move the next chunk forward (it lies within the
    overlap) is passed over; ``crawl=True`` takes it all the same, which then steps
    on by single characters.
    """
    order = order or source
    kind = docs.schema[order].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.assign(text=[split_text(t, size, overlap, crawl) for t in rows["text"]])
            rows["ordinal"] = [range(len(pieces)) for pieces in rows["text"]]
            yield rows[rows["text"].str.len() > 0].explode(["text", "ordinal"]).astype({"ordinal": "int32"})

    picked = bounded(docs).select(
        F.col(source).cast("string").alias("source"), F.col(order).alias("corpus_order"), F.col(text).alias("text")
    )
    cuts = picked.mapInPandas(cut, f"source string, corpus_order {kind}, text string, ordinal int")
    return cuts.select(
        F.concat_ws("::", "source", F.col("ordinal").cast("string")).alias("id"),
        "source", "corpus_order", "ordinal", "text",
    )


def index_stats(chunks: DataFrame) -> DataFrame:
    """How many chunks from how many sources."""
    per_source = chunks.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_chunks"), F.count(F.lit(1)).alias("n_sources")
    )


def chunk_sanity(chunks: DataFrame, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Per source: chunks, and chunks other than the last that are no longer than the overlap."""
    per_source = chunks.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum((F.length("text") <= overlap).cast("long")).alias("short"),
        F.max_by(F.length("text"), F.col("ordinal")).alias("last_length"),
    )
    short = F.col("short") - (F.col("last_length") <= overlap).cast("long")
    return per_source.select("source", "n_chunks", short.alias("n_short"), (short == 0).alias("ok"))
