"""Streaming forms of the incremental operators: first-seen records, and counters kept by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import store


def first_seen(stream: DataFrame, key: str, seen_at: str, late: str = "1 hour") -> DataFrame:
    """The first sighting of each key within the watermark."""
    return stream.withWatermark(seen_at, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, seen_at: str, by: list[str], width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(seen_at, late).groupBy(F.window(seen_at, width), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def keep_counters(stream: DataFrame, keys: list[str], folder: str, checkpoint: str):
    """A query that merges each micro-batch into versioned counter tables under folder; a batch that is replayed writes its own version again."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.select(*keys, "seen_at")
        if number:
            old = spark.read.parquet(f"{folder}/{number - 1}")
        else:
            old = new.groupBy(*keys).agg(F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("latest_seen"), F.count("*").alias("seen_count")).limit(0)
        store.count_seen(old, new, keys).write.mode("overwrite").parquet(f"{folder}/{number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
