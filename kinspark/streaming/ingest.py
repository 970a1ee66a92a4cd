"""Lineage files as a stream: new files of a folder become nodes, file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinspark.operators.tree import build_nodes, fold_text
from kinspark.sources.lineage import line_errors, number_lines, split_rows, tokenize


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of ``(file, _block, raw)``; all splits of a file come in one batch, in
    which number_lines() numbers them."""
    return split_rows(spark.readStream.format("text").load(folder))


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Writes nodes and errors of each batch under its number, so that a batch that
    is run again replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        batch = number_lines(batch).persist()
        fold_text(build_nodes(tokenize(batch, "permissive"))).write.mode("overwrite").parquet(f"{out}/nodes/batch={number}")
        line_errors(batch).write.mode("overwrite").parquet(f"{out}/errors/batch={number}")
        batch.unpersist()

    return stream_lines(spark, folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def events_per_window(events: DataFrame, late: str = "2 days", width: str = "30 days") -> DataFrame:
    """Loads per window of time and tag; works on a stream and on a table."""
    e = events.withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("loaded_at", late)
    return e.groupBy(F.window("loaded_at", width), F.upper("tag").alias("tag")).agg(F.count("*").alias("n"))
