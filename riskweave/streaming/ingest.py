"""Incremental ingest of a corpus: arriving files of documents keep a chunk store up to date.

A change is a source with its text, or with none to delete it, and a number that rises with every change of that source. Of each
source the highest number counts, whenever it arrives; a text that stays as it was is not chunked again. The store is cut into
buckets of sources, and a batch writes the buckets that it changes anew and commits a manifest that names their files, so
readers always see a whole state. The manifest keeps the last batch of every stream: a batch that is run again after a
failure changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators.chunking import chunk_corpus
from riskweave.session import materialize
from riskweave.sources.commits import read_entry, update

CHANGES = "source string, number long, text string"
#: Buckets of sources, by default; a large corpus takes more, so that a bucket stays a few files.
BUCKETS = 64

_SOURCES = "source string, number long, digest string, bucket int"
_CHUNKS = "id string, source string, ordinal int, text string, bucket int"


def read_changes(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of the parquet files of changes that arrive in a folder."""
    return spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def ingest(changes: DataFrame, store: str, checkpoint: str, stream: str = "corpus", buckets: int = BUCKETS, crawl: bool = False) -> StreamingQuery:
    """Apply everything that has arrived and stop; the checkpoint remembers what that was."""
    return (
        changes.writeStream.foreachBatch(lambda batch, number: apply_changes(batch, number, store, stream, buckets, crawl))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("source"), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, store: str, kind: str, parts: dict[str, str], wanted: list[int] | None = None) -> DataFrame:
    """The files of the wanted buckets, by default of all."""
    schema = _SOURCES if kind == "sources" else _CHUNKS
    places = [f"{store}/{kind}/part={p}/bucket={b}" for b, p in parts.items() if wanted is None or int(b) in wanted]
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{store}/{kind}").parquet(*places)


def _write(rows: DataFrame, store: str, kind: str, touched: list[int]) -> dict[str, str | None]:
    """Store whole buckets anew; a bucket without rows is left out of the manifest (None). Rows come dealt out by bucket."""
    part = uuid.uuid4().hex[:12]
    rows.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{store}/{kind}/part={part}")
    held = {r["bucket"] for r in rows.sparkSession.read.schema(rows.schema).parquet(f"{store}/{kind}/part={part}").select("bucket").distinct().collect()}
    return {str(b): part if b in held else None for b in touched}


def _newer(arrived: DataFrame, known: DataFrame, tasks: int) -> DataFrame:
    """The latest change of each source if it is newer than what is known, with the known digest; the text only where it differs.

    Changes and known sources meet in one grouping by bucket and source, so a text is shuffled and stored once.
    """
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    both = arrived.select("bucket", "source", F.struct("number", "text").alias("c"), none("_number", "long"), none("_digest", "string")).unionByName(
        known.select("bucket", "source", none("c", "struct<number:bigint,text:string>"), F.col("number").alias("_number"), F.col("digest").alias("_digest")))
    latest = both.repartition(tasks, "bucket").groupBy("bucket", "source").agg(
        F.max("c").alias("c"), F.max("_number").alias("_number"), F.max("_digest").alias("_digest"))
    newer = latest.where("c is not null and (_number is null or c.number > _number)").select(
        "source", "c.number", "c.text", F.sha2("c.text", 256).alias("digest"), "bucket", "_number", "_digest")
    return materialize(newer.withColumn("text", F.when(~F.col("digest").eqNullSafe(F.col("_digest")), F.col("text"))), "newer-changes")


def _others(chunks: DataFrame, altered: DataFrame, tasks: int) -> DataFrame:
    """The chunks of sources that aren't altered, dealt out by bucket; a chunk is shuffled once."""
    none = [F.lit(None).cast(t).alias(c) for c, t in chunks.dtypes if c not in ("bucket", "source", "part")]
    marks = altered.select("bucket", "source", *none, F.lit(1).alias("_altered"))
    both = chunks.drop("part").withColumn("_altered", F.lit(0)).unionByName(marks).repartition(tasks, "bucket")
    return both.withColumn("_altered", F.max("_altered").over(Window.partitionBy("bucket", "source"))).where("_altered = 0").drop("_altered")


def apply_changes(batch: DataFrame, number: int, store: str, stream: str = "corpus", buckets: int = BUCKETS, crawl: bool = False) -> int:
    """Bring the store up to date with one batch; returns the manifest's version. Changes without a source are passed over."""
    spark = batch.sparkSession
    arrived = batch.where("source is not null").withColumn("bucket", _bucket(buckets))

    def change(version: int, manifest: dict | None) -> dict:
        manifest = manifest or {"buckets": buckets, "sources": {}, "chunks": {}, "batches": {}}
        if manifest["buckets"] != buckets:
            raise ValueError(f"the store has {manifest['buckets']} buckets")
        if manifest["batches"].get(stream, -1) >= number:
            return manifest
        asked = [r[0] for r in arrived.select("bucket").distinct().collect()]  # at most the buckets
        known = _read(spark, store, "sources", manifest["sources"], asked)
        newer = _newer(arrived, known, max(1, len(asked)))
        numbered = [r[0] for r in newer.select("bucket").distinct().collect()]
        sources, chunks = dict(manifest["sources"]), dict(manifest["chunks"])
        if numbered:
            # a deleted source keeps its number, so that an older change that comes late doesn't bring it back
            kept = known.where(F.col("bucket").isin(numbered)).join(newer.select("source"), "source", "left_anti")
            names = ["source", "number", "digest", "bucket"]
            rows = kept.select(names).unionByName(newer.select(names))
            sources |= _write(rows.repartition(len(numbered), "bucket"), store, "sources", numbered)
        altered = newer.where(~F.col("digest").eqNullSafe(F.col("_digest")))
        touched = [r[0] for r in altered.select("bucket").distinct().collect()]
        if touched:
            names = ["id", "source", "ordinal", "text", "bucket"]
            # both sides lie by bucket, so the texts move once
            old = _others(_read(spark, store, "chunks", manifest["chunks"], touched), altered, len(touched))
            cut = chunk_corpus(altered.where("text is not null"), crawl=crawl).withColumn("bucket", _bucket(buckets))
            chunks |= _write(old.select(names).unionByName(cut.select(names)), store, "chunks", touched)
        return {"buckets": buckets, "sources": {b: p for b, p in sources.items() if p}, "chunks": {b: p for b, p in chunks.items() if p},
                "batches": manifest["batches"] | {stream: number}}

    return update(spark, f"{store}/manifests", change)[0]


def read_store(spark: SparkSession, store: str, version: int | None = None) -> DataFrame:
    """``id, source, ordinal, text``: the chunks of a version, by default the latest."""
    found = read_entry(spark, f"{store}/manifests", version)
    if found is None:
        raise FileNotFoundError(f"no chunk store under {store}")
    return _read(spark, store, "chunks", found[1]["chunks"]).drop("bucket", "part")
