"""Keyed state + event-time timers for the streaming jobs.

The pattern processors (logins, orders) buffer a key's rows in list state and
release them in (ts, seq) order once the watermark has passed them, so rows
that arrive out of order inside the watermark delay give the same results as
ordered ones, wherever micro-batch boundaries fall. Deadlines (ends of groups,
timeouts) close when the watermark reaches them. A key's buffer holds the rows
of the watermark delay and of one micro-batch, bounded by the trigger size
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).

The ad blacklist counts clicks as they arrive, one count per local day: its
output feeds windowed aggregations of the same query, which accept no rows
behind the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues)

from clickpulse.functions.timefn import to_micros
from clickpulse.streaming.chunked import fail_sequences_by_chunk, order_pay_by_chunk, order_states_by_chunk
from clickpulse.streaming.panes import sliding_counts_stream
from clickpulse.streaming.windows import ASCENDING, with_event_time

DAY_US = 86_400_000_000


def _micros(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


def _ts(us: int) -> pd.Timestamp:
    return pd.Timestamp(int(us), unit="us")


def _ceil_ms(us: int) -> int:
    return -(-int(us) // 1000)


class EventOrderProcessor(StatefulProcessor):
    """Hands a key's rows to ``advance`` in (ts, seq) order, behind the watermark.

    Subclasses give the rows a ``kind`` (negative: ignored), keep their own
    state, and say when it has to be looked at again (``deadline_us``). One
    timer per key is pending: the earlier of the first buffered row and the
    deadline.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "us long, seq long, kind long")
        self.wake = handle.getValueState("wake", "ms long")
        self.open_state(handle)

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def kinds(self, df: pd.DataFrame) -> np.ndarray:
        raise NotImplementedError

    def advance(self, key, us: np.ndarray, seq: np.ndarray, kind: np.ndarray) -> list[pd.DataFrame]:
        """Rows that no later row can precede, in order."""
        raise NotImplementedError

    def expire(self, key, mark_us: int) -> list[pd.DataFrame]:
        """Close what ended at or before ``mark_us``; all rows up to it have been seen."""
        raise NotImplementedError

    def deadline_us(self) -> int | None:
        raise NotImplementedError

    def _wake_at(self, ms: int) -> None:
        old = self.wake.get()[0] if self.wake.exists() else None
        if old is not None and old <= ms:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)
        self.wake.update((ms,))

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        first = None
        for df in rows:
            us, kind = _micros(df["ts"]), self.kinds(df)
            seq = df["seq"].to_numpy("int64") if "seq" in df.columns else np.zeros(len(df), "int64")
            keep = kind >= 0
            if keep.any():
                self.pending.appendList(list(zip(us[keep].tolist(), seq[keep].tolist(), kind[keep].tolist())))
                low = int(us[keep].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake_at(_ceil_ms(first))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        self.wake.clear()
        rows = sorted(self.pending.get(), key=lambda r: (r[0], r[1])) if self.pending.exists() else []
        n = sum(r[0] <= mark for r in rows)
        out = []
        if n:
            us, seq, kind = (np.array(c, "int64") for c in zip(*rows[:n]))
            out += self.advance(key, us, seq, kind)
            if n < len(rows):
                self.pending.put([tuple(r) for r in rows[n:]])
            else:
                self.pending.clear()
        out += self.expire(key, mark)
        ends = [e for e in (rows[n][0] if n < len(rows) else None, self.deadline_us()) if e is not None]
        if ends:
            self._wake_at(_ceil_ms(min(ends)))
        return iter(out)

    def close(self) -> None:
        pass


# ------------------------------------------------------------------ F1 / F2

BLACKLIST_SCHEMA = ("user_id long, ad_id long, province string, ts timestamp, "
                    "day_index long, click_no long, tag string")


class BlacklistProcessor(StatefulProcessor):
    """Per (user, ad) and local day, in order of arrival: clicks 1..max-1 pass,
    the max-th warns, later clicks drop. A day's count goes once the watermark
    passes its midnight."""

    def __init__(self, max_clicks: int = 100, utc_offset_hours: int = 8):
        self.warn_at = max(int(max_clicks), 2)
        self.off_us = utc_offset_hours * 3_600_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("day_counts", "day long", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        # vectorized: a click bot's batch is one cumulative count per day. Each day
        # has a count of its own, so a late row of the day before resets nothing.
        for df in rows:
            df = df.sort_values([c for c in ("ts", "seq") if c in df.columns], kind="stable")
            day = (_micros(df["ts"]) + self.off_us) // DAY_US
            no = pd.Series(day).groupby(day).cumcount().to_numpy() + 1
            for d in np.unique(day).tolist():
                here = day == d
                if self.days.containsKey((d,)):
                    no[here] += self.days.getValue((d,))[0]
                else:
                    self.handle.registerTimer(((d + 1) * DAY_US - self.off_us) // 1000)
                self.days.updateValue((d,), (int(no[here].max()),))
            show = no <= self.warn_at
            if show.any():
                out = df[show]
                yield pd.DataFrame({"user_id": key[0], "ad_id": key[1], "province": out["province"].to_numpy(),
                                    "ts": out["ts"].to_numpy(), "day_index": day[show], "click_no": no[show],
                                    "tag": np.where(no[show] < self.warn_at, "passed", "blacklist")})

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        over = expiredTimerInfo.getExpiryTimeInMs()
        for (d,) in list(self.days.keys()):
            if ((d + 1) * DAY_US - self.off_us) // 1000 <= over:
                self.days.removeKey((d,))
        return iter([])

    def close(self) -> None:
        pass


def blacklist_stream(clicks: DataFrame, max_clicks: int = 100, delay=ASCENDING,
                     utc_offset_hours: int = 8) -> DataFrame:
    """Tagged clicks (``passed`` / ``blacklist``); ``ts`` keeps its watermark
    so windowed aggregations can follow in the same query."""
    ev = with_event_time(clicks, "ts", delay)
    return ev.groupBy("user_id", "ad_id").transformWithStateInPandas(
        BlacklistProcessor(max_clicks, utc_offset_hours), BLACKLIST_SCHEMA, "Append", "EventTime",
        eventTimeColumnName="ts")


def ad_counts_by_province_stream(clicks: DataFrame, max_clicks: int = 100, size="1 hour",
                                 slide="5 seconds", delay=ASCENDING) -> DataFrame:
    """A4 streaming: blacklist state, then sliding province counts from one ring of panes per province, one query."""
    passed = blacklist_stream(clicks, max_clicks, delay).where(F.col("tag") == "passed")
    return sliding_counts_stream(passed.select("province", "ts"), "ts", ["province"], size, slide, delay=None)


# ---------------------------------------------------------------------- F3

BURST_SCHEMA = "user_id long, first_ts timestamp, last_ts timestamp, n_fails long"


class LoginBurstProcessor(EventOrderProcessor):
    """First fail opens a group and a timer at first + within; fails up to
    the deadline join; a success discards the group; at the deadline a group
    of >= min_fails is reported."""

    def __init__(self, within="2 seconds", min_fails: int = 2, fail: str = "fail"):
        self.w_us = to_micros(within)
        self.min_fails = min_fails
        self.fail = fail

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("group", "first_us long, last_us long, n long")

    def kinds(self, df: pd.DataFrame) -> np.ndarray:
        return (df["event_type"] == self.fail).to_numpy().astype("int64")

    def _emit(self, key, groups) -> list[pd.DataFrame]:
        rows = [(key[0], _ts(g[0]), _ts(g[1]), int(g[2])) for g in groups if g[2] >= self.min_fails]
        return [pd.DataFrame(rows, columns=["user_id", "first_ts", "last_ts", "n_fails"])] if rows else []

    def advance(self, key, us, seq, kind) -> list[pd.DataFrame]:
        # one step per group, not per row: a group's end is a searchsorted on
        # its deadline and a success inside it is a lookup in next_success
        fail = kind == 1
        n = len(us)
        idx = np.arange(n)
        # next_success[i] / next_fail[i]: first index >= i of that kind (n if none)
        next_success = np.append(np.minimum.accumulate(np.where(~fail, idx, n)[::-1])[::-1], n)
        next_fail = np.append(np.minimum.accumulate(np.where(fail, idx, n)[::-1])[::-1], n)
        g = self.state.get() if self.state.exists() else None
        closed = []
        pos = 0
        while True:
            if g is None:
                f = next_fail[pos] if pos < n else n
                if f >= n:
                    break
                g, start = (int(us[f]), int(us[f]), 1), f + 1
            else:
                start = pos
            end = int(np.searchsorted(us, g[0] + self.w_us, side="right"))
            s_ = next_success[start] if start < n else n
            if s_ < end:                       # a success before the deadline
                g, pos = None, s_ + 1
                continue
            if end > start:                    # fails up to the deadline join
                g = (g[0], int(us[end - 1]), g[2] + end - start)
            if end < n:                        # a later event: the deadline has passed
                closed.append(g)
                g, pos = None, end
                continue
            break                              # group still open at the end of the rows
        if g is None:
            self.state.clear()
        else:
            self.state.update((int(g[0]), int(g[1]), int(g[2])))
        return self._emit(key, closed)

    def expire(self, key, mark_us) -> list[pd.DataFrame]:
        if not self.state.exists() or self.deadline_us() > mark_us:
            return []
        g = self.state.get()
        self.state.clear()
        return self._emit(key, [g])

    def deadline_us(self) -> int | None:
        return self.state.get()[0] + self.w_us if self.state.exists() else None


def login_burst_stream(logins: DataFrame, within="2 seconds", min_fails: int = 2,
                       delay="5 seconds") -> DataFrame:
    ev = with_event_time(logins, "ts", delay)
    return ev.groupBy("user_id").transformWithStateInPandas(
        LoginBurstProcessor(within, min_fails), BURST_SCHEMA, "Append", "EventTime")


# ---------------------------------------------------------------------- F9

ORDER_SCHEMA = "order_id long, state string, create_ts timestamp, pay_ts timestamp"


class OrderStateProcessor(EventOrderProcessor):
    """create opens the order (a later create re-anchors it); a pay within
    the timeout (inclusive) pays it; the timer reports ``not_paid``; a pay
    with no open order is ``pay_without_open_order``."""

    def __init__(self, timeout="15 minutes"):
        self.t_us = to_micros(timeout)

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("open_create", "create_us long")

    def kinds(self, df: pd.DataFrame) -> np.ndarray:
        return df["event_type"].map({"create": 0, "pay": 1}).fillna(-1).to_numpy("int64")

    def advance(self, key, us, seq, kind) -> list[pd.DataFrame]:
        # vectorized: in (ts, seq) order each event only needs its neighbour
        # among the key's creates and pays (the batch operator's rule)
        c0 = self.state.get()[0] if self.state.exists() else None
        pay = kind == 1
        if c0 is not None:
            us = np.concatenate([[c0], us])
            pay = np.concatenate([[False], pay])
        n = len(us)
        nxt_us = np.append(us[1:], 0)
        has_nxt = np.arange(n) < n - 1
        close = has_nxt & (nxt_us - us <= self.t_us)
        nxt_pay = np.append(pay[1:], False)
        prv_us = np.insert(us[:-1], 0, 0)
        prv_create = np.insert(~pay[:-1], 0, False)
        prv_close = (np.arange(n) > 0) & prv_create & (us - prv_us <= self.t_us)
        create = ~pay
        paid = create & close & nxt_pay
        not_paid = create & has_nxt & ~close            # a later event passed the deadline
        lone_pay = pay & ~prv_close
        still_open = create & ~has_nxt
        rows_out = []
        for mask, state, c_col, p_col in [(paid, "paid", us, nxt_us),
                                          (not_paid, "not_paid", us, None),
                                          (lone_pay, "pay_without_open_order", None, us)]:
            if mask.any():
                k = int(mask.sum())
                rows_out.append(pd.DataFrame({
                    "order_id": key[0], "state": state,
                    "create_ts": pd.to_datetime(c_col[mask], unit="us") if c_col is not None
                    else pd.Series([pd.NaT] * k, dtype="datetime64[ns]"),
                    "pay_ts": pd.to_datetime(p_col[mask], unit="us") if p_col is not None
                    else pd.Series([pd.NaT] * k, dtype="datetime64[ns]")}))
        if still_open.any():
            self.state.update((int(us[still_open][0]),))
        else:
            self.state.clear()
        return rows_out

    def expire(self, key, mark_us) -> list[pd.DataFrame]:
        if not self.state.exists() or self.deadline_us() > mark_us:
            return []
        c = self.state.get()[0]
        self.state.clear()
        return [pd.DataFrame([(key[0], "not_paid", _ts(c), None)],
                             columns=["order_id", "state", "create_ts", "pay_ts"])]

    def deadline_us(self) -> int | None:
        return self.state.get()[0] + self.t_us if self.state.exists() else None


def order_states_stream(orders: DataFrame, timeout="15 minutes", delay=ASCENDING, chunk=None) -> DataFrame:
    """F9 streaming; ``chunk`` keys the state by (order, time chunk) of at least the timeout (``streaming.chunked``)."""
    if chunk is not None:
        return order_states_by_chunk(orders, ORDER_SCHEMA, timeout, delay, chunk)
    ev = with_event_time(orders, "ts", delay)
    return ev.groupBy("order_id").transformWithStateInPandas(
        OrderStateProcessor(timeout), ORDER_SCHEMA, "Append", "EventTime")


# ------------------------------------------------------------------ F4-F6

PAIRS_SCHEMA = ("user_id long, first_seq long, first_ts timestamp, last_seq long, "
                "last_ts timestamp, n_fails long")


class FailSequenceProcessor(EventOrderProcessor):
    """``begin(fail).times(n).within(t)`` per user.

    State: the last n-1 fails (us, seq). A new fail completes a match with
    the fail n-1 positions back if it is less than ``within`` later. With
    ``consecutive=True`` any other event clears the state (strict
    contiguity; n = 2 is ``begin(fail).next(fail)``). The state goes once no
    match can complete.
    """

    def __init__(self, n: int = 2, within="2 seconds", consecutive: bool = False,
                 fail: str = "fail"):
        self.n = n
        self.w_us = to_micros(within)
        self.consecutive = consecutive
        self.fail = fail

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("recent_fails", "us long, seq long")

    def kinds(self, df: pd.DataFrame) -> np.ndarray:
        return (df["event_type"] == self.fail).to_numpy().astype("int64")

    def _recent(self) -> list[tuple[int, int]]:
        return [tuple(x) for x in self.state.get()] if self.state.exists() else []

    def advance(self, key, us, seq, kind) -> list[pd.DataFrame]:
        # vectorized: matches are index pairs (i, i + n - 1) among the fails,
        # inside one run of fails when other events break runs
        recent = self._recent()
        is_fail = kind == 1
        # run id: events that break contiguity (non-fails, in consecutive mode) start a new run
        breaks = np.cumsum(~is_fail) if self.consecutive else np.zeros(len(us), "int64")
        f_us = np.concatenate([np.array([u for u, _ in recent], "int64"), us[is_fail]])
        f_seq = np.concatenate([np.array([q for _, q in recent], "int64"), seq[is_fail]])
        f_run = np.concatenate([np.zeros(len(recent), "int64"), breaks[is_fail]])
        k = self.n - 1
        out = []
        if len(f_us) > k:
            j = np.arange(max(k, len(recent)), len(f_us))   # matches end at a new fail
            i = j - k
            ok = (f_run[i] == f_run[j]) & (f_us[j] - f_us[i] < self.w_us)
            i, j = i[ok], j[ok]
            if len(j):
                out.append(pd.DataFrame({"user_id": key[0], "first_seq": f_seq[i],
                                         "first_ts": pd.to_datetime(f_us[i], unit="us"),
                                         "last_seq": f_seq[j],
                                         "last_ts": pd.to_datetime(f_us[j], unit="us"),
                                         "n_fails": self.n}))
        # keep the last n-1 fails of the current run
        keep = f_run == breaks[-1]
        recent = list(zip(f_us[keep][-k:].tolist(), f_seq[keep][-k:].tolist()))
        if recent:
            self.state.put([(int(u), int(q)) for u, q in recent])
        else:
            self.state.clear()
        return out

    def expire(self, key, mark_us) -> list[pd.DataFrame]:
        end = self.deadline_us()
        if end is not None and end <= mark_us:
            self.state.clear()
        return []

    def deadline_us(self) -> int | None:
        recent = self._recent()
        return recent[-1][0] + self.w_us if recent else None


def fail_sequence_stream(logins: DataFrame, n: int = 2, within="2 seconds",
                         consecutive: bool = False, delay="5 seconds", chunk=None) -> DataFrame:
    """F4-F6 streaming; ``chunk`` keys the state by (user, time chunk) of at least ``within`` (``streaming.chunked``)."""
    if chunk is not None:
        return fail_sequences_by_chunk(logins, PAIRS_SCHEMA, n, within, consecutive, delay, chunk)
    ev = with_event_time(logins, "ts", delay)
    return ev.groupBy("user_id").transformWithStateInPandas(
        FailSequenceProcessor(n, within, consecutive), PAIRS_SCHEMA, "Append", "EventTime")


# ------------------------------------------------------------------ F7 / F8

CEP_SCHEMA = "order_id long, tag string, create_ts timestamp, pay_ts timestamp"


class OrderPayCepProcessor(EventOrderProcessor):
    """``begin(create).followedBy(pay).within(t)`` with timeout output.

    Every open create is matched by the first pay after it if the pay comes
    less than ``within`` later; otherwise it is reported as ``timeout``.
    """

    def __init__(self, within="15 minutes"):
        self.w_us = to_micros(within)

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getListState("open_creates", "us long")

    def kinds(self, df: pd.DataFrame) -> np.ndarray:
        return df["event_type"].map({"create": 0, "pay": 1}).fillna(-1).to_numpy("int64")

    def _open(self) -> list[int]:
        return [x[0] for x in self.state.get()] if self.state.exists() else []

    def _keep(self, creates: list[int]) -> None:
        if creates:
            self.state.put([(int(c),) for c in creates])
        else:
            self.state.clear()

    def advance(self, key, us, seq, kind) -> list[pd.DataFrame]:
        # vectorized: each create takes the first pay after it (searchsorted)
        before = self._open()
        pos = np.arange(len(us))
        pay_pos = pos[kind == 1]
        c_us = np.concatenate([np.array(before, "int64"), us[kind == 0]])
        c_pos = np.concatenate([np.full(len(before), -1, "int64"), pos[kind == 0]])
        nxt = np.searchsorted(pay_pos, c_pos, side="right")
        has_pay = nxt < len(pay_pos)
        p_us = np.where(has_pay, us[pay_pos[np.minimum(nxt, len(pay_pos) - 1)]]
                        if len(pay_pos) else 0, 0)
        matched = has_pay & (p_us - c_us < self.w_us)
        done = c_us[has_pay]
        self._keep(c_us[~has_pay].tolist())
        if not len(done):
            return []
        m = matched[has_pay]
        return [pd.DataFrame({
            "order_id": key[0],
            "tag": np.where(m, "matched", "timeout"),
            "create_ts": pd.to_datetime(done, unit="us"),
            "pay_ts": pd.to_datetime(np.where(m, p_us[has_pay], 0), unit="us").where(m)})]

    def expire(self, key, mark_us) -> list[pd.DataFrame]:
        creates = self._open()
        done = [c for c in creates if c + self.w_us <= mark_us]
        if not done:
            return []
        self._keep([c for c in creates if c + self.w_us > mark_us])
        return [pd.DataFrame([(key[0], "timeout", _ts(c), None) for c in done],
                             columns=["order_id", "tag", "create_ts", "pay_ts"])]

    def deadline_us(self) -> int | None:
        creates = self._open()
        return min(creates) + self.w_us if creates else None


def order_pay_cep_stream(orders: DataFrame, within="15 minutes", delay=ASCENDING, chunk=None) -> DataFrame:
    """F7/F8 streaming; ``chunk`` keys the state by (order, time chunk) of at least ``within`` (``streaming.chunked``)."""
    if chunk is not None:
        return order_pay_by_chunk(orders, CEP_SCHEMA, within, delay, chunk)
    ev = with_event_time(orders, "ts", delay)
    return ev.groupBy("order_id").transformWithStateInPandas(
        OrderPayCepProcessor(within), CEP_SCHEMA, "Append", "EventTime")
