"""Keyed event patterns: login failures (F3-F6) and order payment.

Events of a key are ordered by (ts, seq). Every pattern here looks only a
bounded time ahead or back (its ``within`` / timeout), so work is partitioned
by (key, time chunk) with halo rows (``plans.chunks.with_halo``) instead of
by key alone: a key holding a third of all rows is still split across many
tasks. Results are those of the event-time reading of each job: all events
of a key processed in (ts, seq) order, nothing dropped as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.timefn import micros_to_ts, is_ntz, to_micros
from clickpulse.plans.chunks import CHUNK, OWN, US, chunk_width, with_halo
from clickpulse.plans.chains import reached

CHUNK_HINT = "1 minute"


def _chunk(distance_us: int, chunk) -> int:
    return chunk_width(4 * distance_us, to_micros(chunk if chunk is not None else CHUNK_HINT))


def _within(delta, bound_us: int, inclusive: bool):
    """Pattern ``within``: strict (<) by default, ``inclusive`` gives <=."""
    return delta <= F.lit(bound_us) if inclusive else delta < F.lit(bound_us)


def _pairs_out(h: DataFrame, key: str, ts: str, seq: str, last) -> DataFrame:
    return h.select(key, F.col(seq).alias("first_seq"), F.col(ts).alias("first_ts"),
                    last[seq].alias("last_seq"), last[ts].alias("last_ts"))


def consecutive_fails(logins: DataFrame, within="2 seconds", key: str = "user_id",
                      ts: str = "ts", seq: str = "seq", type_col: str = "event_type",
                      fail: str = "fail", chunk=None, inclusive: bool = False) -> DataFrame:
    """``begin(fail).next(fail).within(t)``: two strictly consecutive fails
    of a key with last - first < t. Overlapping matches are all reported."""
    w_us = to_micros(within)
    base = logins.select(key, ts, seq, (F.col(type_col) == fail).alias("_fail"))
    h = with_halo(base, ts, _chunk(w_us, chunk), lookahead_us=w_us)
    w = Window.partitionBy(key, CHUNK).orderBy(US, seq)
    nxt = F.lead(F.struct(F.col(US).alias("u"), F.col(ts).alias(ts), F.col(seq).alias(seq),
                          F.col("_fail").alias("f"))).over(w)
    h = h.withColumn("_n", nxt)
    h = h.where(F.col(OWN) & F.col("_fail") & F.col("_n.f")
                & _within(F.col("_n.u") - F.col(US), w_us, inclusive))
    return _pairs_out(h, key, ts, seq, F.col("_n"))


def fails_times_n(logins: DataFrame, n: int = 2, within="2 seconds", consecutive: bool = False,
                  key: str = "user_id", ts: str = "ts", seq: str = "seq",
                  type_col: str = "event_type", fail: str = "fail", chunk=None,
                  inclusive: bool = False) -> DataFrame:
    """``begin(fail).times(n).within(t)``.

    Relaxed contiguity (default): other events may come between the n fails,
    but no fail is skipped, so a match is n consecutive fails among the
    key's fails. ``consecutive=True`` also forbids other events in between.
    """
    if n < 2:
        raise ValueError("n must be at least 2")
    w_us = to_micros(within)
    base = logins.select(key, ts, seq, (F.col(type_col) == fail).alias("_fail"))
    if not consecutive:
        base = base.where("_fail")
    h = with_halo(base, ts, _chunk(w_us, chunk), lookahead_us=w_us)
    w = Window.partitionBy(key, CHUNK).orderBy(US, seq)
    cond = F.col(OWN) & F.col("_fail")
    for i in range(1, n):
        h = h.withColumn(f"_f{i}", F.lead("_fail", i).over(w))
        cond = cond & F.col(f"_f{i}")
    last = F.lead(F.struct(F.col(US).alias("u"), F.col(ts).alias(ts), F.col(seq).alias(seq)),
                  n - 1).over(w)
    h = h.withColumn("_l", last).where(cond & _within(F.col("_l.u") - F.col(US), w_us, inclusive))
    return _pairs_out(h, key, ts, seq, F.col("_l")).withColumn("n_fails", F.lit(n))


def order_pay_cep(orders: DataFrame, within="15 minutes", key: str = "order_id",
                  ts: str = "ts", seq: str = "seq", type_col: str = "event_type",
                  chunk=None, inclusive: bool = False) -> DataFrame:
    """``begin(create).followedBy(pay).within(t)`` with timeouts.

    Each create is matched with the first pay after it (other creates
    between do not interfere) if pay - create < t (tag ``matched``);
    otherwise it times out (tag ``timeout``, ``pay_ts`` null).
    """
    w_us = to_micros(within)
    base = orders.where(F.col(type_col).isin("create", "pay")).select(
        key, ts, seq, (F.col(type_col) == "pay").alias("_pay"))
    h = with_halo(base, ts, _chunk(w_us, chunk), lookahead_us=w_us)
    after = (Window.partitionBy(key, CHUNK).orderBy(F.desc(US), F.desc(seq))
             .rowsBetween(Window.unboundedPreceding, -1))
    pay = F.when(F.col("_pay"), F.struct(F.col(US).alias("u"), F.col(ts).alias(ts)))
    h = (h.where(F.col(OWN) | F.col("_pay"))
         .withColumn("_np", F.last(pay, ignorenulls=True).over(after))
         .where(F.col(OWN) & ~F.col("_pay")))
    ok = F.col("_np").isNotNull() & _within(F.col("_np.u") - F.col(US), w_us, inclusive)
    return h.select(key, F.when(ok, F.lit("matched")).otherwise(F.lit("timeout")).alias("tag"),
                    F.col(ts).alias("create_ts"), F.when(ok, F.col(f"_np.{ts}")).alias("pay_ts"))


def order_pay_states(orders: DataFrame, timeout="15 minutes", key: str = "order_id",
                     ts: str = "ts", seq: str = "seq", type_col: str = "event_type",
                     chunk=None, inclusive: bool = True) -> DataFrame:
    """keyed-state classification of creates and pays.

    A create opens the order (a later create re-anchors it) until a pay at
    most ``timeout`` later (``paid``, inclusive bound) or the deadline
    (``not_paid``). A pay with no open order is ``pay_without_open_order``.
    In (ts, seq) order this only needs each event's neighbour among the
    key's creates and pays, within ``timeout``.
    """
    t_us = to_micros(timeout)
    base = orders.where(F.col(type_col).isin("create", "pay")).select(
        key, ts, seq, (F.col(type_col) == "pay").alias("_pay"))
    h = with_halo(base, ts, _chunk(t_us, chunk), lookahead_us=t_us, lookback_us=t_us)
    w = Window.partitionBy(key, CHUNK).orderBy(US, seq)
    nb = F.struct(F.col(US).alias("u"), F.col(ts).alias(ts), F.col("_pay").alias("p"))
    h = (h.withColumn("_nx", F.lead(nb).over(w)).withColumn("_pv", F.lag(nb).over(w))
         .where(OWN))
    nx_close = F.col("_nx").isNotNull() & _within(F.col("_nx.u") - F.col(US), t_us, inclusive)
    pv_close = F.col("_pv").isNotNull() & _within(F.col(US) - F.col("_pv.u"), t_us, inclusive)
    null_ts = F.lit(None).cast(orders.schema[ts].dataType)
    state = (F.when(~F.col("_pay") & nx_close & F.col("_nx.p"), F.lit("paid"))
             .when(~F.col("_pay") & nx_close & ~F.col("_nx.p"), F.lit(None))
             .when(~F.col("_pay"), F.lit("not_paid"))
             .when(pv_close & ~F.col("_pv.p"), F.lit(None))
             .otherwise(F.lit("pay_without_open_order")))
    return (h.withColumn("state", state).where(F.col("state").isNotNull())
            .select(key, "state",
                    F.when(~F.col("_pay"), F.col(ts)).otherwise(null_ts).alias("create_ts"),
                    F.when(F.col("_pay"), F.col(ts))
                    .when(F.col("state") == "paid", F.col(f"_nx.{ts}"))
                    .otherwise(null_ts).alias("pay_ts")))


def login_fail_bursts(logins: DataFrame, within="2 seconds", min_fails: int = 2,
                      key: str = "user_id", ts: str = "ts", seq: str = "seq",
                      type_col: str = "event_type", fail: str = "fail", chunk=None) -> DataFrame:
    """keyed state + timer burst detection.

    The first fail of a key opens a group and a timer at first + ``within``;
    later fails up to the deadline (inclusive) join it; a success before the
    deadline discards it; at the deadline a group of >= ``min_fails`` fails
    is reported as (key, first_ts, last_ts, n_fails).

    Which fails open groups (anchors) is a greedy chain: the next anchor is
    the first fail after the deadline. The chain restarts at "heads" -- a
    fail whose previous event is a success or lies more than ``within``
    before it. Per fail, bounded-distance facts are computed on halo chunks:
    head flag, size and end of its would-be group, whether a success kills
    it, and ``jump`` = the first fail after its deadline in the same run.
    The anchors are everything reachable from a head through ``jump``
    (``plans.chains.reached``): chains are followed inside each chunk, and
    only what crosses chunks is followed across them, in a fixed number of
    rounds. No job runs while the plan is built. ``seq`` must be unique
    within a key (it names the chain nodes).
    """
    w_us = to_micros(within)
    ntz = is_ntz(logins, ts)
    base = logins.select(key, ts, seq, (F.col(type_col) == fail).alias("_fail"))
    width = _chunk(2 * w_us, chunk)
    h = with_halo(base, ts, width, lookahead_us=2 * w_us, lookback_us=w_us)
    asc = Window.partitionBy(key, CHUNK).orderBy(US, seq)
    upto = asc.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = (Window.partitionBy(key, CHUNK).orderBy(F.desc(US), F.desc(seq))
             .rowsBetween(Window.unboundedPreceding, -1))
    prev = F.lag(F.struct(F.col("_fail").alias("f"), F.col(US).alias("u"))).over(asc)
    h = h.withColumn("_prev", prev)
    cont = F.coalesce(F.col("_prev.f"), F.lit(False)) & (F.col(US) - F.col("_prev.u") <= F.lit(w_us))
    h = (h.withColumn("_head", (F.col("_fail") & ~cont).cast("int"))
         .withColumn("_hc", F.sum("_head").over(upto))
         .withColumn("_ns", F.last(F.when(~F.col("_fail"), F.col(US)), ignorenulls=True).over(after)))
    fl = h.where("_fail")
    fw = Window.partitionBy(key, CHUNK).orderBy(US, seq)
    fl = (fl.withColumn("_fi", F.row_number().over(fw))
          .withColumn("_nx", F.lead(F.struct(F.col(seq).alias("s"), F.col(US).alias("u"), F.col("_hc").alias("hc"))).over(fw)))
    # Each fail becomes a target row (at its own time) and, if owned by the
    # chunk, a probe row at time + within; a running "last target" at each
    # probe is the last fail up to its deadline. One explode instead of a
    # union keeps a single scan and shuffle.
    tgt = F.struct("_fi", F.col(US).alias("u"), "_nx")
    src = F.struct(F.col(seq).alias("s"), "_fi", "_hc", "_head", "_ns", F.col(US).alias("u"))
    no_tgt, no_src = F.when(F.lit(False), tgt), F.when(F.lit(False), src)
    rows = F.array(
        F.struct(F.col(US).alias("pos"), F.lit(1).alias("p"), F.col(seq).alias("q"),
                 tgt.alias("t"), no_src.alias("src")),
        F.when(F.col(OWN), F.struct((F.col(US) + F.lit(w_us)).alias("pos"), F.lit(2).alias("p"),
                                    F.col(seq).alias("q"), no_tgt.alias("t"), src.alias("src"))))
    u = (fl.select(key, CHUNK, F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("_e"))
         .select(key, CHUNK, F.col("_e.pos").alias("_pos"), F.col("_e.p").alias("_p"),
                 F.col("_e.q").alias("_q"), F.col("_e.t").alias("_t"), F.col("_e.src").alias("_src")))
    pw = (Window.partitionBy(key, CHUNK).orderBy("_pos", "_p", "_q")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.withColumn("_last", F.last("_t", ignorenulls=True).over(pw)).where(F.col("_p") == 2)
    same_run = F.col("_last._nx").isNotNull() & (F.col("_last._nx.hc") == F.col("_src._hc"))
    killed = F.col("_src._ns").isNotNull() & (F.col("_src._ns") <= F.col("_src.u") + F.lit(w_us))
    nodes = u.select(
        key, CHUNK, F.col("_src.u").alias("us"), F.col("_src.s").cast("bigint").alias("v"),
        F.when(same_run, F.col("_last._nx.u")).alias("to_us"),
        F.when(same_run, F.col("_last._nx.s")).cast("bigint").alias("to_v"),
        (F.col("_src._head") == 1).alias("flag"),
        # what is reported of an anchor: nothing if a success kills its group
        F.when(killed, F.lit(0)).otherwise(F.col("_last._fi") - F.col("_src._fi") + 1).cast("bigint").alias("n"),
        F.col("_last.u").alias("last_us"))
    anchors = reached(nodes, key, CHUNK, width, 2 * w_us)
    return (anchors.where(F.col("n") >= F.greatest(F.lit(min_fails), F.lit(1)))
            .select(key, micros_to_ts(F.col("us"), ntz).alias("first_ts"),
                    micros_to_ts(F.col("last_us"), ntz).alias("last_ts"), F.col("n").alias("n_fails")))
