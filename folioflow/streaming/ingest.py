"""Streams: records merged as they arrive, and counts by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioflow.functions.text import is_empty


def event_counts(events: DataFrame, time: str = "ts", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """``start, event_type, n, total`` by event-time windows; rows later than the watermark allows are left out of a stream."""
    timed = events.withColumn("at", F.col(time).cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def _partial(rows: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """``key`` and for each field the struct ``place, value`` of its first non-empty value in ``order``, as ``first_<field>``."""
    kinds, place = dict(rows.dtypes), F.struct(*order)
    firsts = [F.min(F.when(~is_empty(F.col(f), kinds[f]), F.struct(place.alias("place"), F.col(f).alias("value")))).alias(f"first_{f}") for f in fields]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*firsts)


def merge_stream(records: DataFrame, folder: str, checkpoint: str, key: str, order: list[str], fields: list[str], available_now: bool = True) -> StreamingQuery:
    """Merges a stream of records: each key's fields keep their first non-empty value in ``order``, in whichever batch it came.

    A micro-batch adds what its own rows say, one row a key, and reads or rewrites nothing of earlier ones; a batch that is run again
    replaces what it wrote. ``merged_table`` puts the batches together. The folder must be one that all executors share.
    """

    def step(batch: DataFrame, number: int) -> None:
        _partial(batch.select(key, *order, *fields), key, order, fields).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _together(spark: SparkSession, folder: str, key: str) -> DataFrame:
    parts = spark.read.parquet(folder).drop("batch")
    return parts.groupBy(key).agg(*[F.min(c).alias(c) for c in parts.columns if c != key])


def merged_table(spark: SparkSession, folder: str, key: str = "key") -> DataFrame | None:
    """``key`` and the merged fields after the batches so far, or None before the first."""
    if not _exists(spark, folder):
        return None
    parts = _together(spark, folder, key)
    return parts.select(key, *[F.col(f"{c}.value").alias(c.removeprefix("first_")) for c in parts.columns if c != key])


def compact(spark: SparkSession, folder: str, into: str, key: str = "key") -> None:
    """Writes the batches of a stopped stream as one batch of another folder, from which a stream with later batch numbers goes on."""
    _together(spark, folder, key).write.parquet(f"{into}/batch=-1")
