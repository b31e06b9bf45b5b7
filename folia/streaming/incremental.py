"""Incremental indexing with Structured Streaming: landing files to postings, windows over events, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.operators import bm25


def landing(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def index_documents(docs: DataFrame, out: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text"):
    """Append postings and lengths of each batch, once: a batch writes a folder named by its number, so a replay overwrites its own."""

    def batch(df: DataFrame, number: int) -> None:
        bm25.postings(df, id_col, text_col).write.mode("overwrite").parquet(f"{out}/postings/batch={number}")
        bm25.doc_lengths(df, id_col, text_col).write.mode("overwrite").parquet(f"{out}/lengths/batch={number}")

    return docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def timed(stream: DataFrame, time: str) -> DataFrame:
    """Event time as a timestamp with time zone, which watermarks ask for."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def first_seen(stream: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """Rows whose keys were not seen within the watermark: state is bounded by it."""
    return timed(stream, time).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return timed(stream, time).withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return timed(stream, time).withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))
