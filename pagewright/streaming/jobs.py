"""Structured Streaming forms of the processing loop: incremental backlog, job tracking, event windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# fixed values: statuses of a job that end it
TERMINAL = ["completed", "failed", "cancelled"]


def backlog_stream(spark: SparkSession, documents: str, schema, done: Callable[[], DataFrame], process: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Processes what is new in a folder of Parquet and not in done(), once; rerun it to go on.

    done() gives the keys (document_id) that the sink already has, read anew for every batch.
    """

    def batch(df: DataFrame, _: int) -> None:
        todo = df.join(done(), "document_id", "left_anti")
        process(todo).write.mode("append").parquet(sink)

    return spark.readStream.schema(schema).parquet(documents).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_status(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """The last status of every job by its event time, and whether it ended. Works on streams and tables."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    g = e.groupBy("job_id").agg(F.max_by("status", "ts").alias("status"), F.max("ts").alias("ts"))
    return g.withColumn("terminal", F.col("status").isin(TERMINAL))


def event_windows(events: DataFrame, size: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums of each event type in tumbling or sliding windows; ts must be a timestamp."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return e.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """Events of a user that follow each other within the gap, as one session."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")
