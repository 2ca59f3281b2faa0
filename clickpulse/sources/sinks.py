"""Sinks: tagged side outputs (S8) and upserts of corrected results.

A job's main and side outputs are one DataFrame with a ``tag`` column. It is
written once, partitioned by tag, so the source is scanned once and each
consumer reads its own ``tag=<name>`` folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_tagged(df: DataFrame, path: str, tag_col: str = "tag", mode: str = "overwrite") -> None:
    """Batch: one Parquet folder per tag value, written by a single job."""
    df.write.mode(mode).partitionBy(tag_col).parquet(path)


def read_tag(spark: SparkSession, path: str, tag: str, tag_col: str = "tag") -> DataFrame:
    """One side output; the tag filter prunes the other folders."""
    return spark.read.parquet(path).where(F.col(tag_col) == tag).drop(tag_col)


def tagged_stream(df: DataFrame, path: str, checkpoint: str, tag_col: str = "tag",
                  trigger: dict | None = None):
    """Streaming: exactly-once Parquet file sink partitioned by tag."""
    w = (df.writeStream.format("parquet").partitionBy(tag_col).option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def changelog_sink(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for update-mode results.

    Each micro-batch is written to its own ``epoch=<id>`` folder with
    overwrite, so a replayed epoch replaces its own output (exactly once).
    ``read_latest`` resolves the log to the newest value per key.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
    return run


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row per key across the changelog epochs."""
    log = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.desc("epoch"))
    return (log.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .drop("_r", "epoch"))


def compact_changelog(spark: SparkSession, path: str, target: str, keys: list[str]) -> int:
    """Write the newest row per key of the log at ``path`` as one epoch of a new log at ``target``.

    The epoch keeps the number of the newest one read, so that later epochs
    of the stream (appended to ``target`` by :func:`changelog_sink`) still
    win. Returns that number; the old log can be removed once no reader
    uses it. Run it between stream restarts, as ``path`` must not change
    meanwhile.
    """
    last = spark.read.parquet(path).agg(F.max("epoch")).first()[0]
    read_latest(spark, path, keys).write.mode("overwrite").parquet(f"{target}/epoch={last}")
    return last
