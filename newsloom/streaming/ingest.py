"""Incremental ingest with Structured Streaming.

Newly landed entry files are micro-batches of the ingest job. What it must remember is the article
table itself, so there is no growing state store; each micro-batch writes under its own number and
can be replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsloom.functions.urls import url_key
from newsloom.operators.dedup import THRESHOLD
from newsloom.plans.ingest import run_batch
from newsloom.schema import RAW_ENTRIES
from newsloom.sources.feeds import collect, decoded, parse_feeds
from newsloom.sources.tables import TableStore

LANDED_ENTRIES = T.StructType(RAW_ENTRIES.fields + [T.StructField("position", T.IntegerType())])
INTERVAL = "60 minutes"


def entry_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed entry files (Parquet) as a stream."""
    reader = spark.readStream.schema(LANDED_ENTRIES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def feed_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed feed documents, each in the encoding that it declares, as a stream of `(source_id, document)`."""
    reader = spark.readStream.schema("path string, modificationTime timestamp, length bigint, content binary, source_id int").format("binaryFile")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(root).select("source_id", decoded(F.col("content")).alias("document"))


def unique_url_stream(entries: DataFrame, watermark: str | None = None) -> DataFrame:
    """First row per URL on the stream alone.

    Without a watermark every URL is remembered; with one (on `published`) only those of the given
    span, which bounds the state.
    """
    keyed = entries.withColumn("url_key", url_key(F.col("url")))
    if watermark is None:
        return keyed.dropDuplicates(["url_key"])
    return keyed.withWatermark("published", watermark).dropDuplicatesWithinWatermark(["url_key"])


def start_ingest(stream: DataFrame, store: TableStore, pages: DataFrame, profiles: DataFrame,
                 checkpoint: str, threshold: float = THRESHOLD, feeds: bool = False,
                 once: bool = False) -> StreamingQuery:
    """Run the ingest job on every micro-batch.

    `once` works off what has landed and stops; otherwise a batch starts every 60 minutes. With
    `feeds`, the stream holds feed documents, and entries of active sources are taken from them.
    """

    def ingest(batch_rows: DataFrame, batch_id: int) -> None:
        rows, damaged = batch_rows, 0
        if feeds:
            parsed = parse_feeds(batch_rows)
            damaged = parsed.where("feed._broken IS NOT NULL").count()
            rows = collect(parsed, store.sources(before=batch_id + 1))
        run_batch(store, batch_id + 1, rows, pages, profiles, threshold, damaged=damaged)

    writer = stream.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=INTERVAL)
    return writer.start()
