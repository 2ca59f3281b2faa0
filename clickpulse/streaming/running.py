"""A8 as a stream: one row per input row with its window's distinct count so far.

First a keyed state per (window, member bucket) tells each row whether its
member is new to the window, in event order behind the watermark. The rows
that one micro-batch releases are exactly those between the last watermark
and this one, so the sink can number them with the batch plan (running sums
by (window, minute)) on top of the windows' totals of earlier micro-batches.
No task holds a window; state holds each window's members once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpulse.functions.hashing import bitmap_offset
from clickpulse.functions.timefn import to_micros
from clickpulse.plans.sliding import floor_div
from clickpulse.streaming.stateful import EventOrderProcessor
from clickpulse.streaming.windows import ASCENDING, with_event_time

FIRST_SEEN_SCHEMA = "window_us long, us long, seq long, first long"
_TOTALS = "window_us long, total long, epoch long"


class FirstSeenProcessor(EventOrderProcessor):
    """Per (window, bucket): rows in event order, ``first`` 1 for a member not seen before in the window."""

    def __init__(self, size_us: int):
        self.size_us = size_us

    def open_state(self, handle) -> None:
        self.seen = handle.getMapState("seen", "member long", "us long")
        self.window = handle.getValueState("window", "us long")

    def kinds(self, df: pd.DataFrame) -> np.ndarray:
        return df["member"].to_numpy("int64")

    def advance(self, key, us, seq, kind) -> list[pd.DataFrame]:
        if not self.window.exists():
            self.window.update((int(key[0]),))
        first = np.zeros(len(us), np.int64)
        members, at = np.unique(kind, return_index=True)
        for m, i in zip(members.tolist(), at.tolist()):
            if not self.seen.containsKey((m,)):
                self.seen.updateValue((m,), (int(us[i]),))
                first[i] = 1
        return [pd.DataFrame({"window_us": int(key[0]), "us": us, "seq": seq, "first": first})]

    def expire(self, key, mark_us) -> list[pd.DataFrame]:
        end = self.deadline_us()
        if end is not None and end <= mark_us:
            self.seen.clear()
            self.window.clear()
        return []

    def deadline_us(self) -> int | None:
        return self.window.get()[0] + self.size_us if self.window.exists() else None


def first_seen_stream(stream: DataFrame, size="1 hour", cap: int | None = 1 << 30, user: str = "user_id",
                      ts: str = "ts", seq: str = "seq", behavior: str | None = "pv", delay=ASCENDING,
                      buckets: int = 64) -> DataFrame:
    """(window_us, us, seq, first): every row once the watermark has passed it, marked if its member is new.

    Members are the bitmap offsets of the users; without ``cap`` 63 bits of
    the users' hash. A window's members are dealt to ``buckets`` states.
    """
    src = stream.where(F.col("behavior") == behavior) if behavior else stream
    size_us = to_micros(size)
    member = bitmap_offset(F.col(user), cap) if cap else F.shiftrightunsigned(F.xxhash64(user), 1)
    ev = with_event_time(src.select(F.col(ts).alias("ts"), F.col(seq).cast("bigint").alias("seq"),
                                    member.cast("bigint").alias("member")), "ts", delay)
    ev = ev.where("member IS NOT NULL").withColumn("window_us", floor_div(F.unix_micros("ts"), size_us) * F.lit(size_us))
    return (ev.withColumn("bucket", F.pmod(F.xxhash64("member"), F.lit(buckets)))
            .groupBy("window_us", "bucket").transformWithStateInPandas(
                FirstSeenProcessor(size_us), FIRST_SEEN_SCHEMA, "Append", "EventTime"))


def running_sink(path: str, size="1 hour", chunk="1 minute", out: str = "uv") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: numbers a micro-batch of ``first_seen_stream`` and writes it below ``path``.

    Rows go to ``rows/epoch=<id>``, the windows' new members to
    ``totals/epoch=<id>``; a repeated epoch overwrites its own folders and
    reads the totals of earlier ones only, so each row is written once.
    """
    size_us, chunk_us = to_micros(size), to_micros(chunk)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()             # read by several plans: the state must move once
        rows = batch.withColumn("_rc", floor_div(F.col("us"), chunk_us))
        totals = rows.groupBy("window_us").agg(F.sum("first").alias("total"))
        try:
            old = (spark.read.schema(_TOTALS).parquet(f"{path}/totals").where(F.col("epoch") < epoch_id)
                   .groupBy("window_us").agg(F.sum("total").alias("_carry")))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            old = spark.createDataFrame([], "window_us long, _carry long")        # the first epoch
        inside = Window.partitionBy("window_us", "_rc").orderBy("us", "seq").rowsBetween(Window.unboundedPreceding, 0)
        before = Window.partitionBy("window_us").orderBy("_rc").rowsBetween(Window.unboundedPreceding, -1)
        minutes = (rows.groupBy("window_us", "_rc").agg(F.sum("first").alias("_t"))
                   .select("window_us", "_rc", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
                   .join(old, "window_us", "left").na.fill(0, ["_carry"]))
        ran = (rows.withColumn("_in", F.sum("first").over(inside)).join(minutes, ["window_us", "_rc"])
               .select("seq", F.timestamp_micros("us").alias("ts"), F.timestamp_micros("window_us").alias("window_start"),
                       F.timestamp_micros(F.col("window_us") + F.lit(size_us)).alias("window_end"),
                       (F.col("_in") + F.col("_off") + F.col("_carry")).cast("bigint").alias(out)))
        ran.write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch_id}")
        totals.write.mode("overwrite").parquet(f"{path}/totals/epoch={epoch_id}")
        batch.unpersist()
    return run


def read_running(spark: SparkSession, path: str) -> DataFrame:
    """The numbered rows written so far."""
    return spark.read.parquet(f"{path}/rows").drop("epoch")
