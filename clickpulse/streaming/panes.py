"""Sliding windows of a stream from one ring of pane counts per key.

``window(ts, size, slide)`` keeps one state row per key and window, and
expands a row once per overlap (120 or 720 times). Here a key's state is one
row: the counts of its panes of gcd(size, slide) still needed, in order. The
windows that are due are differences of the ring's prefix sums; panes leave
the ring once no window needs them.

Two processors use it: :class:`SlidingProcessor` emits every window once,
from pane counts that are final; :class:`FiredWindowProcessor` counts rows
itself, fires a window when the stream has passed its end and fires it again
for late rows up to the allowed lateness.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues)

from clickpulse.functions.timefn import interval_str, to_micros
from clickpulse.streaming.windows import ASCENDING, with_event_time

_NEVER = -(1 << 62)


class Ring:
    """Pane counts of a key: ``counts[i]`` belongs to pane ``first + i``; windows are [k step, k step + wide) panes."""

    def __init__(self, size_us: int, slide_us: int):
        self.size_us, self.slide_us = size_us, slide_us
        self.pane_us = math.gcd(size_us, slide_us)
        self.wide, self.step = size_us // self.pane_us, slide_us // self.pane_us
        self.first, self.counts = 0, np.zeros(0, np.int64)

    def load(self, first: int, data: bytes) -> "Ring":
        self.first, self.counts = first, np.frombuffer(data, np.int64).copy()
        return self

    def add(self, panes: np.ndarray, counts: np.ndarray) -> None:
        if not len(panes):
            return
        low, high = int(panes.min()), int(panes.max()) + 1
        if len(self.counts):
            low, high = min(low, self.first), max(high, self.first + len(self.counts))
        grown = np.zeros(high - low, np.int64)
        if len(self.counts):
            at = self.first - low
            grown[at:at + len(self.counts)] = self.counts
        np.add.at(grown, panes - low, counts)
        self.first, self.counts = low, grown

    def first_window(self, pane: int) -> int:
        """The earliest window that holds ``pane``."""
        return (pane - self.wide) // self.step + 1

    def last_window(self, pane: int) -> int:
        return pane // self.step

    def end_us(self, k: int) -> int:
        return k * self.slide_us + self.size_us

    def window_ended_by(self, us: int) -> int:
        """The latest window whose end is at or before ``us``."""
        return (us - self.size_us) // self.slide_us

    def sums(self, ks: np.ndarray) -> np.ndarray:
        """Counts of the windows ``ks``."""
        total = np.concatenate([[0], np.cumsum(self.counts)])
        at = lambda pane: total[np.clip(pane - self.first, 0, len(self.counts))]
        return at(ks * self.step + self.wide) - at(ks * self.step)

    def drop_before(self, k: int) -> None:
        """Forget the panes that window ``k`` and later ones do not hold, and empty panes at the front."""
        self.counts = self.counts[max(0, k * self.step - self.first):]
        self.first = max(self.first, k * self.step)
        held = np.flatnonzero(self.counts)
        skip = int(held[0]) if len(held) else len(self.counts)
        self.first, self.counts = self.first + skip, self.counts[skip:]

    def due(self, after: int, upto: int) -> np.ndarray:
        """The windows in (after, upto] that hold a pane of the ring."""
        if not len(self.counts):
            return np.zeros(0, np.int64)
        low = max(after + 1, self.first_window(self.first))
        high = min(upto, self.last_window(self.first + len(self.counts) - 1))
        return np.arange(low, high + 1, dtype=np.int64)


def _ceil_ms(us: int) -> int:
    return -(-int(us) // 1000)


class _RingProcessor(StatefulProcessor):
    """One value state per key (its ring and how far windows were emitted) and one pending timer."""

    def __init__(self, keys: list[str], size_us: int, slide_us: int):
        self.keys, self.size_us, self.slide_us = keys, size_us, slide_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ring", "first long, counts binary, done long, wake long")

    def _open(self) -> tuple[Ring, int, int | None]:
        ring = Ring(self.size_us, self.slide_us)
        if not self.state.exists():
            return ring, _NEVER, None
        first, counts, done, wake = self.state.get()
        return ring.load(first, bytes(counts)), done, None if wake == _NEVER else wake

    def _close(self, ring: Ring, done: int, wake: int | None, wanted_us: int | None) -> None:
        ms = None if wanted_us is None else _ceil_ms(wanted_us)
        if wake is not None and wake != ms:
            self.handle.deleteTimer(wake)
        if ms is None:
            self.state.clear()
            return
        if wake != ms:
            self.handle.registerTimer(ms)
        self.state.update((ring.first, ring.counts.tobytes(), done, ms))

    def _rows(self, key, ring: Ring, ks: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        start = ks * self.slide_us
        return pd.DataFrame({**{c: key[i] for i, c in enumerate(self.keys)},
                             "window_start": pd.to_datetime(start, unit="us"),
                             "window_end": pd.to_datetime(start + self.size_us, unit="us"), "cnt": counts})

    def close(self) -> None:
        pass


class SlidingProcessor(_RingProcessor):
    """Emits every window with rows once, when the watermark passes its end; input are final pane counts."""

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        ring, done, wake = self._open()
        for df in rows:
            ring.add(df["pane"].to_numpy("int64"), df["n_rows"].to_numpy("int64"))
        self._close(ring, done, wake, ring.end_us(max(done + 1, ring.first_window(ring.first))))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        ring, done, _ = self._open()
        upto = ring.window_ended_by(timerValues.getCurrentWatermarkInMs() * 1000)
        ks = ring.due(done, upto)
        counts = ring.sums(ks)
        out = self._rows(key, ring, ks[counts > 0], counts[counts > 0])
        ring.drop_before(upto + 1)
        wanted = ring.end_us(max(upto + 1, ring.first_window(ring.first))) if len(ring.counts) else None
        self._close(ring, upto, None, wanted)
        return iter([out] if len(out) else [])


def _schema(df: DataFrame, keys: list[str], *more: T.StructField) -> T.StructType:
    return T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys]
                        + [T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
                           T.StructField("cnt", T.LongType()), *more])


def sliding_counts_stream(stream: DataFrame, ts: str, keys: list[str], size, slide, delay=ASCENDING) -> DataFrame:
    """Sliding counts with many overlaps: native pane counts, then one ring per key.

    Rows are combined into pane counts before anything is kept per key, so a
    hot key sends one row per pane and task. ``delay=None`` keeps a watermark
    the stream already carries. Append mode; the result equals the batch
    counts of the rows the watermark lets in.
    """
    size_us, slide_us = to_micros(size), to_micros(slide)
    g = math.gcd(size_us, slide_us)
    ev = with_event_time(stream, ts, delay) if delay is not None else stream
    panes = (ev.groupBy(F.window(ts, interval_str(g)).alias("_p"), *keys).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(*keys, F.window_time("_p").alias("pane_ts"),
                     (F.unix_micros(F.col("_p.start")) / F.lit(g)).cast("bigint").alias("pane"), "n_rows"))
    return panes.groupBy(*keys).transformWithStateInPandas(
        SlidingProcessor(keys, size_us, slide_us), _schema(stream, keys), "Append", "EventTime")


class FiredWindowProcessor(_RingProcessor):
    """Counts rows; a window is fired when the fire time passes its end, and again for every micro-batch with
    late rows until the fire time passes its end by ``lateness``.

    The fire time is the newest event time minus the out-of-orderness. The
    stream's watermark trails it by lateness + size, so that no row which a
    window still takes is dropped before it gets here.
    """

    def __init__(self, keys: list[str], size_us: int, slide_us: int, lateness_us: int):
        super().__init__(keys, size_us, slide_us)
        self.lateness_us = lateness_us

    def _advance(self, key, rows, timerValues: TimerValues, pending: bool) -> Iterator[pd.DataFrame]:
        ring, done, wake = self._open()
        if not pending:
            wake = None
        at = timerValues.getCurrentWatermarkInMs() * 1000 + self.lateness_us + self.size_us     # the fire time
        expired, ended = ring.window_ended_by(at - self.lateness_us), ring.window_ended_by(at)
        # windows that are over by now take none of the rows that come with this call
        out = [self._emit(key, ring, ring.due(done, expired), "fired")]
        before, done = done, max(done, expired)
        new = [np.unique(df["us"].to_numpy("int64") // ring.pane_us, return_counts=True) for df in rows]
        late = np.zeros(0, np.int64)
        if new and before > expired:
            late = np.unique(np.concatenate([np.arange(ring.first_window(p), ring.last_window(p) + 1)
                                             for p in np.unique(np.concatenate([n[0] for n in new])).tolist()]))
            late = late[(late > expired) & (late <= before)]
        known = ring.sums(late) > 0             # else the late rows are the window's first
        for panes, counts in new:
            ring.add(panes, counts)
        out += [self._emit(key, ring, ring.due(done, ended), "fired"), self._emit(key, ring, late[~known], "fired"),
                self._emit(key, ring, late[known], "corrected")]
        done = max(done, ended)
        ring.drop_before(expired + 1)
        wanted = None
        if len(ring.counts):
            # the first pane goes when its last window expires; the next window fires before or after that
            ends = [ring.end_us(ring.last_window(ring.first)) - self.size_us]
            nxt = max(done + 1, ring.first_window(ring.first))
            if nxt <= ring.last_window(ring.first + len(ring.counts) - 1):
                ends.append(ring.end_us(nxt) - self.lateness_us - self.size_us)
            wanted = min(ends)
        self._close(ring, done, wake, wanted)
        return iter([df for df in out if len(df)])

    def _emit(self, key, ring: Ring, ks: np.ndarray, kind: str) -> pd.DataFrame:
        counts = ring.sums(ks)
        return self._rows(key, ring, ks[counts > 0], counts[counts > 0]).assign(kind=kind)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        return self._advance(key, rows, timerValues, pending=True)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._advance(key, [], timerValues, pending=False)


def fired_counts_stream(stream: DataFrame, keys: list[str], size="10 minutes", slide="5 seconds",
                        out_of_order="2 seconds", lateness="1 minute", ts: str = "ts") -> DataFrame:
    """Sliding counts that fire at the window's end and are corrected by late rows.

    (keys, window_start, window_end, cnt, kind): ``fired`` when the newest
    event time has passed the window's end by ``out_of_order``, ``corrected``
    with the new count in every micro-batch that brings rows for a fired
    window, up to ``lateness`` after its end. Windows still open are not
    emitted. The newest row of a (keys, window) is its count. A key's state is
    one row; its rows of a micro-batch are counted in one task.
    """
    size_us, slide_us, late_us = to_micros(size), to_micros(slide), to_micros(lateness)
    delay = to_micros(out_of_order) + late_us + size_us
    ev = with_event_time(stream.select(*keys, ts), ts, f"{delay} microseconds")
    ev = ev.select(*keys, ts, F.unix_micros(ts).alias("us"))
    return ev.groupBy(*keys).transformWithStateInPandas(
        FiredWindowProcessor(keys, size_us, slide_us, late_us),
        _schema(stream, keys, T.StructField("kind", T.StringType())), "Append", "EventTime",
        eventTimeColumnName="window_end")
