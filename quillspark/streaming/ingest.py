"""Continuous ingestion: new documents are cut into chunks as they arrive; events are counted by window with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunks import fingerprint
from ..plans import pipeline

DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, received_at TIMESTAMP"


def document_stream(spark: SparkSession, path: str, files_a_batch: int = 64) -> DataFrame:
    """Documents from Parquet files that arrive below a path, a bounded number of files a batch."""
    return spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def once_each(docs: DataFrame, delay: str = "7 days") -> DataFrame:
    """Drops documents whose normalised text came before within ``delay``; state older than that is given up."""
    keyed = docs.withColumn("fp", F.md5(fingerprint(F.col("text"))))
    return keyed.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["fp"]).drop("fp")


def chunk_stream(docs: DataFrame, spec: pipeline.Spec | None = None) -> DataFrame:
    """The pipeline on a stream: all its passes work row by row, so it needs no state."""
    return pipeline.run(spec or pipeline.default_spec(), docs)


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, event_type, events, value) by tumbling windows; events later than ``late`` are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    grouped = timed.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return grouped.agg(F.count("*").alias("events"), F.sum("value").alias("value")).select(F.col("window.start").alias("window_start"), "event_type", "events", "value")


def start(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream to Parquet, exactly once by the checkpoint, with what is there now and then stops."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
