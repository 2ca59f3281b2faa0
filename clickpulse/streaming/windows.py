"""Streaming twins of the windowed operators.

Streams carry ``timestamp`` (not ``timestamp_ntz``) event time, as
``withWatermark`` requires; ``as_event_time`` converts without depending on
the session zone.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.hashing import bitmap_offset
from clickpulse.functions.timefn import as_event_time, interval_str, to_micros
from clickpulse.operators.topn import top_n
from clickpulse.plans.sliding import floor_div


# Watermark delay for ascending timestamps: watermark = max event time - 1 ms.
# Spark drops rows at or below the watermark, so a zero delay would drop rows
# tied with the previous micro-batch's latest row; 1 ms keeps them.
ASCENDING = "1 millisecond"


def with_event_time(stream: DataFrame, ts: str = "ts", delay=ASCENDING) -> DataFrame:
    """Event time + watermark: ``delay`` is the bounded out-of-orderness
    (``ASCENDING`` for ordered timestamps; 2 s / 5 s in the log and login jobs)."""
    return (stream.withColumn(ts, as_event_time(stream, ts))
            .withWatermark(ts, interval_str(to_micros(delay))))


def window_counts_stream(stream: DataFrame, ts: str, keys: list[str], size, slide=None,
                         delay=ASCENDING, panes: bool = False, out: str = "cnt",
                         processing_time: bool = False, output_mode: str = "append") -> DataFrame:
    """Sliding counts; in append mode a window is emitted once the watermark
    passes its end. Rows older than the watermark are dropped.

    ``panes=True`` chains the count: tumbling panes of gcd(size, slide)
    first, then windows over the pane counts, so each row enters one state
    entry instead of one per overlap (``pane_counts_stream`` with
    ``pane_window_sink`` is the cheapest form for very many overlaps). Spark
    runs chained aggregations in append mode only: asking for another
    ``output_mode`` is an error. ``processing_time=True`` windows rows by
    arrival time instead.
    """
    if panes and output_mode != "append":
        raise ValueError(f"panes=True needs output_mode='append', not {output_mode!r}: "
                         "Spark does not chain aggregations in other modes")
    size_us = to_micros(size)
    slide_us = to_micros(slide if slide is not None else size)
    if processing_time:
        # T4: windows on arrival time (the channel job sets no event time)
        stream = stream.withColumn(ts, F.current_timestamp())
    ev = with_event_time(stream, ts, delay)
    w = (interval_str(size_us), interval_str(slide_us))
    if not panes:
        agg = ev.groupBy(F.window(ts, *w).alias("_w"), *keys).agg(F.count(F.lit(1)).alias(out))
    else:
        g = interval_str(math.gcd(size_us, slide_us))
        pane = ev.groupBy(F.window(ts, g).alias("_p"), *keys).agg(F.count(F.lit(1)).alias("_c"))
        agg = (pane.groupBy(F.window(F.window_time("_p"), *w).alias("_w"), *keys)
               .agg(F.sum("_c").alias(out)))
    return agg.select(*keys, F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"), F.col(out).cast("bigint").alias(out))


def top_n_sink(key_cols: list[str], n: int, sink: Callable[[DataFrame, int], None]):
    """``foreachBatch`` function ranking each micro-batch of closed windows.

    In append mode all rows of a window arrive in the micro-batch that
    closes it, so per-batch ranking equals ranking the whole window.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        sink(top_n(batch, key_cols, n), epoch_id)
    return run


def interval_join_stream(left: DataFrame, right: DataFrame, on: str, left_ts: str,
                         right_ts: str, lower="-3 seconds", upper="5 seconds",
                         how: str = "inner", left_delay=ASCENDING,
                         right_delay=ASCENDING, bucket=None) -> DataFrame:
    """Stream-stream interval join; watermarks bound the buffered state.

    ``how='full_outer'`` emits unmatched rows once the watermark passes their
    bound (the J2 side outputs).

    ``bucket`` (a width) puts a time bucket into the join key, so that a hot
    key's state and partners spread over its buckets: a left row has one
    bucket, a right row goes to each bucket its partners can be in. That is
    exact for ``inner`` and ``left_outer``; the right side's unmatched rows
    would come once per copy, so ``full_outer`` by buckets is
    ``reconcile_stream(chunk=...)``.
    """
    lo, hi = to_micros(lower), to_micros(upper)
    lft = with_event_time(left, left_ts, left_delay).withColumnRenamed(on, "_lk")
    rgt = with_event_time(right, right_ts, right_delay)
    cond = F.col("_lk") == F.col(on)
    if bucket is not None:
        if how not in ("inner", "left_outer"):
            raise ValueError(f"bucket= does not apply to how={how!r}")
        b = max(to_micros(bucket), 1)
        lft = lft.withColumn("_lb", floor_div(F.unix_micros(left_ts), b))
        rgt = rgt.withColumn("_rb", F.explode(F.sequence(floor_div(F.unix_micros(right_ts) - F.lit(hi), b),
                                                         floor_div(F.unix_micros(right_ts) - F.lit(lo), b))))
        cond = cond & (F.col("_lb") == F.col("_rb"))
    cond = cond & \
        (F.col(right_ts) >= F.col(left_ts) + F.expr(f"INTERVAL {lo} MICROSECONDS")) & \
        (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {hi} MICROSECONDS"))
    j = lft.join(rgt, cond, how).drop("_lb", "_rb")
    return j.withColumn(on, F.coalesce(F.col("_lk"), F.col(on))).drop("_lk")


def url_counts_with_lateness(log: DataFrame, size="10 minutes", slide="5 seconds",
                             out_of_order="2 seconds", lateness="1 minute",
                             method: str | None = "GET", ts: str = "ts") -> DataFrame:
    """Sliding URL counts that are corrected by late rows.

    The reference fires a window when the watermark (max ts - out_of_order)
    passes its end and re-fires it for each late row up to ``lateness``
    later. In Spark terms: watermark delay = out_of_order + lateness, output
    mode ``update`` (every changed (window, url) count is re-emitted), and
    the consumer upserts on (window_end, url) -- ``sources.sinks.
    changelog_sink`` + ``read_latest``. Windows the reference has fired are
    those with ``window_end <= max event time - out_of_order``.
    """
    delay = to_micros(out_of_order) + to_micros(lateness)
    src = log.where(F.col("method") == method) if method else log
    ev = with_event_time(src.select("url", ts), ts, f"{delay} microseconds")
    w = ev.groupBy(F.window(ts, interval_str(to_micros(size)),
                            interval_str(to_micros(slide))).alias("_w"), "url")
    return w.agg(F.count(F.lit(1)).alias("cnt")).select(
        "url", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
        F.col("cnt").cast("bigint").alias("cnt"))


def uv_stream(stream: DataFrame, size="1 hour", user: str = "user_id", ts: str = "ts",
              delay=ASCENDING, approx: bool = False, out: str = "uv") -> DataFrame:
    """A6 / A9 streaming: distinct users per tumbling window, append mode.

    Exact: chained aggregations -- (window, user) first, then a count per
    window -- since ``count_distinct`` is not a streaming aggregate.
    ``approx=True`` keeps one HLL sketch per window instead of one state row
    per (window, user).
    """
    ev = with_event_time(stream, ts, delay)
    w = F.window(ts, interval_str(to_micros(size)))
    if approx:
        agg = ev.groupBy(w.alias("_w")).agg(F.approx_count_distinct(user).alias(out))
    else:
        per_user = ev.groupBy(w.alias("_w"), user).agg(F.count(F.lit(1)).alias("_n"))
        agg = (per_user.groupBy(F.window(F.window_time("_w"), interval_str(to_micros(size)))
                                .alias("_w")).agg(F.count(F.lit(1)).alias(out)))
    return agg.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      F.col(out).cast("bigint").alias(out))


def reconcile_stream(pays: DataFrame, receipts: DataFrame, on: str = "tx_id",
                     pay_ts: str = "pay_ts", receipt_ts: str = "receipt_ts",
                     lower="-3 seconds", upper="5 seconds", pay_delay=ASCENDING,
                     receipt_delay=ASCENDING, chunk=None) -> DataFrame:
    """J2 streaming: full outer interval join, tagged like the batch ``reconcile``.

    Unmatched pays / receipts are emitted once the watermark passes the end
    of their match range (the reference's timers). ``chunk`` keys the state
    by (key, time chunk) instead, so that a hot key spreads over its chunks;
    every row is decided in the one chunk it belongs to, where copies of the
    neighbours' rows stand for both sides (``streaming.chunked``).
    """
    if chunk is not None:
        from clickpulse.streaming.chunked import reconcile_by_chunk
        return reconcile_by_chunk(pays, receipts, on, pay_ts, receipt_ts, lower, upper, pay_delay, receipt_delay, chunk)
    j = interval_join_stream(pays.select(on, pay_ts), receipts.select(on, receipt_ts), on,
                             pay_ts, receipt_ts, lower, upper, "full_outer",
                             pay_delay, receipt_delay)
    status = (F.when(F.col(pay_ts).isNotNull() & F.col(receipt_ts).isNotNull(), F.lit("matched"))
              .when(F.col(pay_ts).isNotNull(), F.lit("paid_no_receipt"))
              .otherwise(F.lit("receipt_no_pay")))
    return j.select(on, status.alias("status"), pay_ts, receipt_ts)


def rows_dropped_by_watermark(query) -> int:
    """T5: late rows dropped by the stateful operators in the last progress."""
    progress = query.lastProgress or {}
    return sum(int(op.get("numRowsDroppedByWatermark", 0))
               for op in progress.get("stateOperators", []))


def top_n_from_changelog(spark, path: str, key_cols: list[str], n: int = 5,
                         watermark=None) -> DataFrame:
    """R2 with late corrections: rank the newest count of every (window, key).

    Reads the update-mode changelog written by ``sources.sinks.changelog_sink``;
    a window touched by a late row is re-ranked with its corrected counts.
    ``watermark`` (a datetime: the newest event time minus the out-of-orderness,
    ``fired_watermark``) keeps windows that have fired, those with
    ``window_end <= watermark``; windows still open are left out.
    """
    from clickpulse.sources.sinks import read_latest
    latest = read_latest(spark, path, [*key_cols, "window_start", "window_end"])
    if watermark is not None:
        latest = latest.where(F.col("window_end") <= F.lit(watermark).cast(latest.schema["window_end"].dataType))
    return top_n(latest, key_cols, n)


def fired_watermark(query, out_of_order="2 seconds", lateness="1 minute"):
    """The event time up to which windows have fired: max event time - ``out_of_order``.

    The stream's own watermark trails by ``out_of_order + lateness``
    (``url_counts_with_lateness``), so it is that plus ``lateness``. None
    before the first watermark.
    """
    text = ((query.lastProgress or {}).get("eventTime") or {}).get("watermark")
    if not text or text.startswith("1970-01-01T00:00:00"):
        return None
    at = datetime.datetime.strptime(text, "%Y-%m-%dT%H:%M:%S.%fZ")
    return at + datetime.timedelta(microseconds=to_micros(lateness))


def pane_counts_stream(stream: DataFrame, ts: str, keys: list[str], size, slide,
                       delay=ASCENDING) -> DataFrame:
    """Finalized pane counts (``keys``, ``_pane``, ``_c``) of width gcd(size, slide).

    Append mode emits a pane once the watermark passes its end. Pair with
    :func:`pane_window_sink` for sliding windows with many overlaps: the
    stream keeps one state row per (key, pane), and the windows are expanded
    per micro-batch by the batch pane plan. ``delay=None`` keeps a watermark
    the stream already carries (e.g. the blacklist output).
    """
    g = math.gcd(to_micros(size), to_micros(slide))
    ev = with_event_time(stream, ts, delay) if delay is not None else stream
    agg = ev.groupBy(F.window(ts, interval_str(g)).alias("_p"), *keys).agg(
        F.count(F.lit(1)).alias("_c"))
    return agg.select(*keys, (F.unix_micros(F.col("_p.start")) / F.lit(g)).cast("bigint")
                      .alias("_pane"), "_c")


def pane_window_sink(path: str, keys: list[str], size, slide, ntz: bool = True):
    """``foreachBatch`` function: expand a micro-batch of finalized panes into
    window count deltas, written to ``epoch=<id>`` (overwrite: exactly once).
    :func:`read_window_counts` sums the deltas."""
    from clickpulse.plans.sliding import expand_panes
    size_us, slide_us = to_micros(size), to_micros(slide)

    def run(batch: DataFrame, epoch_id: int) -> None:
        (expand_panes(batch, keys, size_us, slide_us, ntz)
         .write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}"))
    return run


def read_window_counts(spark, path: str, keys: list[str], out: str = "cnt") -> DataFrame:
    """Window counts so far: the sum of the per-epoch deltas. A window is
    final once the stream's watermark has passed its end."""
    return (spark.read.parquet(path).groupBy(*keys, "window_start", "window_end")
            .agg(F.sum(out).cast("bigint").alias(out)))


def bitmap_store_stream(stream: DataFrame, size="1 hour", cap: int = 1 << 30, user: str = "user_id",
                        ts: str = "ts", delay=ASCENDING) -> DataFrame:
    """A7 streaming: the rows of ``operators.bitmap_store``, a window's once the watermark passes its end.

    Written to a file sink, the parts of any number of streams and batches
    are one store: ``operators.uv_from_bitmaps`` merges them.
    """
    ev = with_event_time(stream.select(bitmap_offset(F.col(user), cap).alias("_off"), ts), ts, delay)
    agg = (ev.where(F.col("_off").isNotNull())
           .groupBy(F.window(ts, interval_str(to_micros(size))).alias("_w"), F.bitmap_bucket_number("_off").alias("bucket"))
           .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_off")).alias("bitmap")))
    return agg.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "bucket", "bitmap")


def sketch_store_stream(stream: DataFrame, pane="5 minutes", user: str = "user_id", ts: str = "ts", delay=ASCENDING,
                        lg_config_k: int = 12) -> DataFrame:
    """A9 streaming: one HLL sketch per pane, once the watermark passes its end (``operators.uv_from_sketches``)."""
    ev = with_event_time(stream.select(user, ts), ts, delay)
    agg = (ev.groupBy(F.window(ts, interval_str(to_micros(pane))).alias("_w"))
           .agg(F.hll_sketch_agg(user, lg_config_k).alias("sketch")))
    return agg.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "sketch")
