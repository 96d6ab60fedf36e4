"""Evidence as it arrives: an optional front, an addition of this engine. Batch operators are the reference; streams feed them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LINES = "doc_id long, page_no long, i long, text string, source string, x0 long, y0 long, x1 long, y1 long"


def line_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """Line tables that are put into a folder, as a stream of bounded batches."""
    return spark.readStream.schema(LINES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_batches(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Every batch through a batch operator, written under its number, so that a batch that is run again replaces itself. Pages must not be split over batches."""

    def one(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, time: str = "ts", length: str = "1 hour", late: str = "2 hours", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Events per window and key; on a stream, state is dropped two hours after the latest event."""
    found = events.withWatermark(time, late) if events.isStreaming else events
    return found.groupBy(F.window(time, length).alias("w"), *keys).agg(F.count("*").alias("events"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), *keys, "events", "total")
