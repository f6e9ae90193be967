"""Streaming: chunk files that land in a folder, and the state of tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

CHUNKS = "book STRING, chunk_label STRING, start INT, end INT, text STRING"
POLLS = "task STRING, state STRING, at TIMESTAMP"


def chunk_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks from JSON files as they land."""
    return spark.readStream.schema(CHUNKS).json(folder)


def ingest(stream: DataFrame, sink: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Gives each micro-batch's chunks, one a (book, start), to sink; a repeated batch gives the same rows."""

    def each(batch: DataFrame, _: int) -> None:
        i = F.row_number().over(W.partitionBy("book", "start").orderBy("chunk_label", "text"))
        sink(batch.withColumn("i", i).where("i = 1").drop("i"))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def task_states(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """(task, state, at): the latest state of each task of a stream of (task, state, at); late rows are dropped."""
    latest = stream.withWatermark("at", late).groupBy("task").agg(F.max(F.struct("at", "state")).alias("m"))
    return latest.select("task", "m.state", "m.at")
