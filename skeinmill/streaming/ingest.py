"""Canonical tables kept up to date from a stream of contributions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skeinmill.operators.merge import merged


def contributions(spark: SparkSession, path: str, schema: str, kind: str = "json", files_per_batch: int = 1_000) -> DataFrame:
    """Contributions as they arrive in a folder."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def once_per_key(rows: DataFrame, key: list[str], at: str, late: str = "1 day") -> DataFrame:
    """The first delivery of each key; state is dropped once deliveries are older than ``late``."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def counts_per_window(rows: DataFrame, at: str, keys: list[str], size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(start, keys..., n): contributions per event-time window and key."""
    return rows.withWatermark(at, late).groupBy(F.window(at, size), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def upserting(read: Callable[[SparkSession], DataFrame], write: Callable[[DataFrame, int], None], key: str = "id", buckets: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges a batch behind the table's rows of the same keys.

    ``read`` gives the table as it stands, ``write`` replaces the rows of the keys in
    the frame it gets; it receives the batch id and has to be idempotent for
    it. Only rows whose keys are in the batch are read and rewritten.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        keys = batch.select(key).distinct()
        old = read(batch.sparkSession).join(keys, key, "left_semi").withColumn("_ord", F.lit(0))
        both = old.unionByName(batch.withColumn("_ord", F.lit(1)), allowMissingColumns=True)
        tie = [c for c in ("ingested_at", "record_id") if c in both.columns]
        write(merged(both, key, ["_ord", *tie]).drop("_ord"), batch_id)

    return run


def start(rows: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Starts a merging stream; with ``available_now`` it ends when what is there has been taken in."""
    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
