"""Top-N per window in bounded state, corrected when counts grow.

Counts of a (window, key) only grow (late rows add), so a key outside the
first n needs no state: should it rise, it comes again with its new count.
A window's keys are dealt to ``salts`` partial rankings of n rows; what
enters or changes there goes on to the window's ranking of n rows. No task
gathers a window's keys, and state is (salts + 1) x n rows per window.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues)

from clickpulse.functions.timefn import to_micros
from clickpulse.streaming.panes import fired_counts_stream


class TopNProcessor(StatefulProcessor):
    """The n largest counts seen for one window (of one salt, or of all): larger first, ties by key.

    ``ranking`` False emits the rows that entered or changed, True the whole
    ranking with a revision number whenever it changes.
    """

    def __init__(self, key_type: str, n: int, close_us: int, ranking: bool):
        self.key_type, self.n, self.close_us, self.ranking = key_type, n, close_us, ranking

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"key {self.key_type}, cnt long")
        self.revision = handle.getValueState("revision", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        known = {k: c for k, c in self.best.get()} if self.best.exists() else {}
        if not known:
            end = pd.Timestamp(key[1]).value // 1000
            self.handle.registerTimer(max(-(-(end + self.close_us) // 1000), timerValues.getCurrentWatermarkInMs() + 1))
        now = dict(known)
        for df in rows:
            for k, c in df.groupby("key")["cnt"].max().items():
                now[k] = max(int(c), now.get(k, 0))
        first = sorted(now.items(), key=lambda e: (-e[1], e[0]))[:self.n]
        changed = [(k, c) for k, c in first if known.get(k) != c]
        if not changed:
            return iter([])
        self.best.put(first)
        head = {"window_start": key[0], "window_end": key[1]}
        if not self.ranking:
            return iter([pd.DataFrame({**head, "salt": key[2], "key": [k for k, _ in changed],
                                       "cnt": [c for _, c in changed]})])
        revision = (self.revision.get()[0] if self.revision.exists() else 0) + 1
        self.revision.update((revision,))
        return iter([pd.DataFrame({**head, "rank": range(1, len(first) + 1), "key": [k for k, _ in first],
                                   "cnt": [c for _, c in first], "revision": revision})])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.best.clear()
        self.revision.clear()
        return iter([])

    def close(self) -> None:
        pass


def top_n_stream(counts: DataFrame, key: str, n: int = 5, salts: int = 16, close="0 seconds") -> DataFrame:
    """(window_start, window_end, rank, key, cnt, revision): a window's ranking whenever it changes.

    ``counts`` is a stream of (key, window_start, window_end, cnt) with its
    watermark on ``window_end`` whose counts of a (window, key) never fall,
    such as ``fired_counts_stream``. A window's state goes once the watermark
    passes its end + ``close`` (negative where the watermark trails the
    windows). The highest revision of a window is its ranking.
    """
    kind = counts.schema[key].dataType
    close_us = to_micros(close)
    when = [T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType())]
    row = [T.StructField("key", kind), T.StructField("cnt", T.LongType())]
    salted = counts.select("window_start", "window_end", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("salt"),
                           F.col(key).alias("key"), F.col("cnt").cast("bigint").alias("cnt"))
    name = kind.simpleString()
    part = salted.groupBy("window_start", "window_end", "salt").transformWithStateInPandas(
        TopNProcessor(name, n, close_us, False), T.StructType([*when, T.StructField("salt", T.IntegerType()), *row]),
        "Append", "EventTime", eventTimeColumnName="window_end")
    whole = part.groupBy("window_start", "window_end").transformWithStateInPandas(
        TopNProcessor(name, n, close_us, True),
        T.StructType([*when, T.StructField("rank", T.IntegerType()), *row, T.StructField("revision", T.LongType())]),
        "Append", "EventTime")
    return whole.withColumnRenamed("key", key)


def latest_ranking(rankings: DataFrame) -> DataFrame:
    """The newest revision of every window (a batch read of what ``top_n_stream`` wrote)."""
    w = Window.partitionBy("window_start", "window_end")
    return (rankings.withColumn("_newest", F.max("revision").over(w)).where("revision = _newest")
            .drop("_newest", "revision"))


def hot_urls_stream(log: DataFrame, n: int = 5, size="10 minutes", slide="5 seconds", out_of_order="2 seconds",
                    lateness="1 minute", method: str | None = "GET", salts: int = 16) -> DataFrame:
    """R2 as a stream: URLs per fired window, ranked again when late rows correct a count."""
    src = log.where(F.col("method") == method) if method else log
    fired = fired_counts_stream(src, ["url"], size, slide, out_of_order, lateness)
    # the watermark trails a window's last correction by the window's size
    return top_n_stream(fired, "url", n, salts, close=f"-{to_micros(size)} us")
