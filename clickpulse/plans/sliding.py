"""Sliding and tumbling window counts.

``window(ts, size, slide)`` expands every row into ceil(size/slide) copies
through one ``Expand`` projection per overlap. That is fine for a dozen
overlaps, but at 120 or 720 overlaps the projection list blows past
whole-stage codegen and the plan becomes an order of magnitude slower.

The pane plan (Li et al., "No Pane, No Gain", SIGMOD Record 2005) first
aggregates rows into panes of width gcd(size, slide) -- a cheap tumbling
aggregation with map-side partial aggregation -- then explodes each
(key, pane) count into the windows that contain the pane with
``explode(sequence(k_lo, k_hi))`` over long window indexes, and sums.
Only panes, not raw rows, are expanded, and the expansion never crosses the
network. Two exchanges carry pane counts: the partial counts by (key, pane),
then the panes by (key, time bucket of the window start), each pane going to
the at most two buckets its windows start in; windows are expanded and summed
inside the task. Shuffle volume is about three times the pane count whatever
the overlap; ``window()`` shuffles up to one row per overlap. The time bucket
also splits a hot key across tasks. Both plans give the same values and types.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.timefn import epoch_micros, interval_str, is_ntz, micros_to_ts, to_micros

DIRECT_MAX_OVERLAPS = 4


def floor_div(a: Column, b: int) -> Column:
    """Exact floor division of a long column by a positive constant."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("bigint")


def window_counts(df: DataFrame, ts: str, keys: list[str], size, slide=None, *,
                  weight: str | None = None, out: str = "cnt",
                  max_direct_overlaps: int = DIRECT_MAX_OVERLAPS,
                  plan: str = "auto") -> DataFrame:
    """Count (or sum ``weight``) per key and window ``[start, start + size)``.

    Window starts are multiples of ``slide`` from the epoch, as with
    ``window()``. Returns ``keys + [window_start, window_end, out]``; only
    windows holding at least one row appear. ``plan`` is ``auto``,
    ``direct`` (``window()``) or ``pane``.
    """
    size_us = to_micros(size)
    slide_us = to_micros(slide if slide is not None else size)
    overlaps = math.ceil(size_us / slide_us)
    if plan == "auto":
        plan = "direct" if overlaps <= max_direct_overlaps else "pane"
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
    out_type = df.agg(agg.alias("_c")).schema["_c"].dataType
    if plan == "direct":
        w = F.window(ts, interval_str(size_us), interval_str(slide_us))
        return (df.groupBy(w.alias("_w"), *keys).agg(agg.alias(out))
                .select(*keys, F.col("_w.start").alias("window_start"),
                        F.col("_w.end").alias("window_end"), out))
    return _pane_counts(df, ts, keys, size_us, slide_us, agg, out, out_type)


def _pane_counts(df, ts, keys, size_us, slide_us, agg, out, out_type):
    g = math.gcd(size_us, slide_us)
    us = epoch_micros(df, ts)
    panes = (df.where(F.col(ts).isNotNull())
             .groupBy(*keys, floor_div(us, g).alias("_pane"))
             .agg(agg.alias("_c")))
    return expand_panes(panes, keys, size_us, slide_us, is_ntz(df, ts), out, out_type=out_type)


def expand_panes(panes: DataFrame, keys: list[str], size_us: int, slide_us: int, ntz: bool = True,
                 out: str = "cnt", bucket_us: int | None = None, out_type="bigint") -> DataFrame:
    """Sum pane counts (``keys``, ``_pane`` index of width gcd(size, slide), ``_c``)
    into sliding windows -> ``keys + [window_start, window_end, out]``, ``out``
    of type ``out_type``.

    Shared by the batch pane plan and the streaming pane sink.
    """
    g = math.gcd(size_us, slide_us)
    # time bucket of a window = bucket of its start; width >= size, so a pane
    # feeds windows of at most two buckets
    b_us = max(size_us, bucket_us or 0)
    b_us = (b_us + slide_us - 1) // slide_us * slide_us
    q = F.col("_pane")
    # window k = [k*slide, k*slide + size) contains pane [q*g, (q+1)*g)
    # iff k*slide <= q*g and (q+1)*g <= k*slide + size
    k_hi = floor_div(q * F.lit(g), slide_us)
    k_lo = -floor_div(F.lit(size_us) - (q + F.lit(1)) * F.lit(g), slide_us)
    per_b = b_us // slide_us            # windows starting in one bucket
    panes = (panes.withColumn("_klo", k_lo).withColumn("_khi", k_hi)
             .withColumn("_b", F.explode(F.sequence(floor_div(F.col("_klo"), per_b),
                                                    floor_div(F.col("_khi"), per_b)))))
    # Only pane counts cross the network: one shuffle by (key, bucket), then
    # every window of a bucket is expanded and summed inside its task. The
    # partition count is explicit: the pane shuffle is small, and AQE would
    # otherwise coalesce it into a few tasks that then carry the whole
    # overlap-fold expansion.
    n_parts = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kb_lo = F.greatest(F.col("_klo"), F.col("_b") * F.lit(per_b))
    kb_hi = F.least(F.col("_khi"), (F.col("_b") + F.lit(1)) * F.lit(per_b) - F.lit(1))
    wins = (panes.repartition(n_parts, *keys, "_b")
            .select(*keys, "_b", "_c", F.explode(F.sequence(kb_lo, kb_hi)).alias("_k"))
            .groupBy(*keys, "_b", "_k").agg(F.sum("_c").alias(out)))
    start = F.col("_k") * F.lit(slide_us)
    return wins.select(*keys, micros_to_ts(start, ntz).alias("window_start"),
                       micros_to_ts(start + F.lit(size_us), ntz).alias("window_end"),
                       F.col(out).cast(out_type).alias(out))


def tumbling_bounds(df: DataFrame, ts: str, size) -> tuple[Column, Column]:
    """(window_start, window_end) of the tumbling window holding each row."""
    size_us = to_micros(size)
    ntz = is_ntz(df, ts)
    start = floor_div(epoch_micros(df, ts), size_us) * F.lit(size_us)
    return micros_to_ts(start, ntz), micros_to_ts(start + F.lit(size_us), ntz)
