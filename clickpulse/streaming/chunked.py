"""Event patterns and reconciliation on streams, state keyed by (key, time chunk).

The keyed processors of ``streaming.stateful`` hold a key's rows in one
state; here a key's rows are dealt to chunks of its time, the rows near an
edge copied into the neighbour chunk as in the batch operators
(``plans.chunks``). A chunk is evaluated once, when the watermark has passed
its end and the distance the pattern looks ahead: then nothing can be
missing, whatever the order of arrival. A hot key's backlog spreads over as
many tasks as it has chunks, each row is written to state once and read
once, and a chunk's state goes with its evaluation. The price is latency: a
chunk's results come together at its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues)

from clickpulse.functions.timefn import to_micros
from clickpulse.plans.chunks import CHUNK, OWN, US, chunk_width, halo_copies
from clickpulse.streaming.windows import with_event_time


class ChunkProcessor(StatefulProcessor):
    """Holds the rows of one (key, chunk) and evaluates them in (time, seq) order once they are complete.

    ``evaluate(key, us, seq, kind, own)`` returns the result rows; ``own``
    marks the chunk's rows, the others are the neighbours' copies.
    """

    def __init__(self, width_us: int, ahead_us: int, evaluate: Callable):
        self.width_us, self.ahead_us, self.evaluate = width_us, ahead_us, evaluate

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "us long, seq long, kind int, own boolean")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        fresh = not self.rows.exists()
        for df in rows:
            self.rows.appendList(list(zip(df["us"].tolist(), df["seq"].tolist(), df["kind"].tolist(), df["own"].tolist())))
        if fresh:
            self.handle.registerTimer(-(-((int(key[1]) + 1) * self.width_us + self.ahead_us) // 1000))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = np.array([tuple(r) for r in self.rows.get()], dtype=np.int64)
        self.rows.clear()
        us, seq, kind, own = rows[np.lexsort((rows[:, 1], rows[:, 0]))].T
        out = self.evaluate(key[0], us, seq, kind, own.astype(bool))
        return iter([out] if len(out) else [])

    def close(self) -> None:
        pass


def _by_chunk(rows: DataFrame, key: str, width_us: int, ahead_us: int, back_us: int, schema: str | T.StructType,
              evaluate: Callable) -> DataFrame:
    """``rows`` (key, ts, seq, kind) dealt to chunks with their halo and evaluated chunk by chunk."""
    copies = halo_copies(rows.withColumn(US, F.unix_micros("ts")), width_us, ahead_us, back_us)
    # a state's columns reach Python by name: none may start with an underscore
    rows = copies.select(key, F.col(CHUNK).alias("chunk"), "ts", F.col(US).alias("us"), "seq", "kind",
                         F.col(OWN).alias("own"))
    return rows.groupBy(key, "chunk").transformWithStateInPandas(
        ChunkProcessor(width_us, ahead_us, evaluate), schema, "Append", "EventTime")


def _times(us: np.ndarray, known: np.ndarray | None = None) -> pd.Series:
    out = pd.Series(pd.to_datetime(us, unit="us"))
    return out if known is None else out.where(known)


def _width(distance_us: int, chunk) -> int:
    return chunk_width(distance_us, to_micros(chunk))


def fail_sequences(n: int, within_us: int, consecutive: bool) -> Callable:
    """Evaluation of ``begin(fail).times(n).within(t)``; kind 1 is a fail."""
    def evaluate(key, us, seq, kind, own):
        if not consecutive:
            us, seq, kind, own = (a[kind == 1] for a in (us, seq, kind, own))
        i = np.arange(max(0, len(us) - n + 1))
        ok = own[i] & (us[i + n - 1] - us[i] < within_us)
        for step in range(n):
            ok &= kind[i + step] == 1
        i = i[ok]
        return pd.DataFrame({"user_id": key, "first_seq": seq[i], "first_ts": _times(us[i]),
                             "last_seq": seq[i + n - 1], "last_ts": _times(us[i + n - 1]), "n_fails": n})
    return evaluate


def pays_after_creates(within_us: int) -> Callable:
    """Evaluation of ``begin(create).followedBy(pay).within(t)`` with timeouts; kind 1 is a pay."""
    def evaluate(key, us, seq, kind, own):
        pay = np.flatnonzero(kind == 1)
        create = np.flatnonzero((kind == 0) & own)
        nxt = np.searchsorted(pay, create, side="right")
        pay_us = np.append(us[pay], 0)[nxt]
        matched = (nxt < len(pay)) & (pay_us - us[create] < within_us)
        return pd.DataFrame({"order_id": key, "tag": np.where(matched, "matched", "timeout"),
                             "create_ts": _times(us[create]), "pay_ts": _times(np.where(matched, pay_us, 0), matched)})
    return evaluate


def order_states(timeout_us: int) -> Callable:
    """Evaluation of the order states; kind 1 is a pay, each event needs its neighbours only."""
    def evaluate(key, us, seq, kind, own):
        pay, gap = kind == 1, np.diff(us)
        close_next = np.append(gap <= timeout_us, False)
        close_last = np.insert(gap <= timeout_us, 0, False)
        next_pay, last_create = np.append(pay[1:], False), np.insert(~pay[:-1], 0, False)
        paid = ~pay & close_next & next_pay
        lost = ~pay & ~close_next
        lone = pay & ~(close_last & last_create)
        keep = own & (paid | lost | lone)
        next_us = np.append(us[1:], 0)
        pay_us = np.where(paid, next_us, us)
        return pd.DataFrame({
            "order_id": key, "state": np.select([paid, lost], ["paid", "not_paid"], "pay_without_open_order")[keep],
            "create_ts": _times(us[keep], ~pay[keep]), "pay_ts": _times(pay_us[keep], ~lost[keep])})
    return evaluate


def reconciled(lower_us: int, upper_us: int) -> Callable:
    """Evaluation of the interval match of pays (kind 0) and receipts (kind 1), unmatched sides included."""
    def evaluate(key, us, seq, kind, own):
        pay, receipt = us[kind == 0], us[kind == 1]
        mine = us[(kind == 0) & own]
        low = np.searchsorted(receipt, mine + lower_us, side="left")
        n = np.searchsorted(receipt, mine + upper_us, side="right") - low
        pairs = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        theirs = us[(kind == 1) & own]
        alone = theirs[np.searchsorted(pay, theirs - upper_us, side="left")
                       == np.searchsorted(pay, theirs - lower_us, side="right")]
        lost = mine[n == 0]
        sizes = [len(pairs), len(lost), len(alone)]
        zero = np.zeros
        p = np.concatenate([np.repeat(mine, n), lost, zero(len(alone), "int64")])
        r = np.concatenate([receipt[pairs], zero(len(lost), "int64"), alone])
        status = np.repeat(["matched", "paid_no_receipt", "receipt_no_pay"], sizes)
        return pd.DataFrame({"key": key, "status": status, "pay_ts": _times(p, status != "receipt_no_pay"),
                             "receipt_ts": _times(r, status != "paid_no_receipt")})
    return evaluate


def fail_sequences_by_chunk(logins: DataFrame, schema: str, n: int, within, consecutive: bool, delay, chunk,
                            fail: str = "fail") -> DataFrame:
    w = to_micros(within)
    ev = with_event_time(logins, "ts", delay)
    rows = ev.select("user_id", "ts", F.col("seq").cast("bigint").alias("seq"),
                     F.coalesce((F.col("event_type") == fail).cast("int"), F.lit(0)).alias("kind"))
    return _by_chunk(rows if consecutive else rows.where("kind = 1"), "user_id", _width(w, chunk), w, 0, schema,
                     fail_sequences(n, w, consecutive))


def _order_rows(orders: DataFrame, delay) -> DataFrame:
    ev = with_event_time(orders, "ts", delay).where(F.col("event_type").isin("create", "pay"))
    seq = F.col("seq") if "seq" in orders.columns else F.lit(0)
    return ev.select("order_id", "ts", seq.cast("bigint").alias("seq"),
                     (F.col("event_type") == "pay").cast("int").alias("kind"))


def order_pay_by_chunk(orders: DataFrame, schema: str, within, delay, chunk) -> DataFrame:
    w = to_micros(within)
    return _by_chunk(_order_rows(orders, delay), "order_id", _width(w, chunk), w, 0, schema, pays_after_creates(w))


def order_states_by_chunk(orders: DataFrame, schema: str, timeout, delay, chunk) -> DataFrame:
    t = to_micros(timeout)
    return _by_chunk(_order_rows(orders, delay), "order_id", _width(t, chunk), t, t, schema, order_states(t))


def reconcile_by_chunk(pays: DataFrame, receipts: DataFrame, on: str, pay_ts: str, receipt_ts: str, lower, upper,
                       pay_delay, receipt_delay, chunk) -> DataFrame:
    """J2 with both sides in one state per (key, chunk): pairs, and what stays alone, at the chunk's end."""
    lo, hi = to_micros(lower), to_micros(upper)
    reach = max(abs(lo), abs(hi))
    both = None
    for kind, (side, ts, delay) in enumerate([(pays, pay_ts, pay_delay), (receipts, receipt_ts, receipt_delay)]):
        ev = with_event_time(side.select(F.col(on).alias("key"), F.col(ts).alias("ts")), "ts", delay)
        # without key or time nothing matches and nothing is ever complete
        ev = ev.where(F.col("key").isNotNull() & F.col("ts").isNotNull())
        ev = ev.select("key", "ts", F.lit(0).cast("bigint").alias("seq"), F.lit(kind).alias("kind"))
        both = ev if both is None else both.unionByName(ev)
    schema = T.StructType([T.StructField("key", pays.schema[on].dataType), T.StructField("status", T.StringType()),
                           T.StructField("pay_ts", T.TimestampType()), T.StructField("receipt_ts", T.TimestampType())])
    out = _by_chunk(both, "key", _width(reach, chunk), reach, reach, schema, reconciled(lo, hi))
    return out.select(F.col("key").alias(on), "status", F.col("pay_ts").alias(pay_ts),
                      F.col("receipt_ts").alias(receipt_ts))
