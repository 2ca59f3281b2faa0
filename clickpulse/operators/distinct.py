"""Unique visitors per window: exact, bitmap, running and sketch forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.hashing import bitmap_offset
from clickpulse.functions.timefn import epoch_micros, is_ntz, micros_to_ts, to_micros
from clickpulse.plans.sliding import floor_div, tumbling_bounds, window_counts


def _windowed(df: DataFrame, ts: str, size) -> DataFrame:
    start, end = tumbling_bounds(df, ts, size)
    return df.withColumn("window_start", start).withColumn("window_end", end)


def uv_exact(df: DataFrame, size="1 hour", user: str = "user_id", ts: str = "ts",
             behavior: str | None = None, out: str = "uv") -> DataFrame:
    """Exact distinct users per tumbling window.

    Spark plans this as a dedup by (window, user) followed by a count per
    window, both with map-side partial aggregation, so a hot window or a
    hot user does not land in one task.
    """
    src = df.where(F.col("behavior") == behavior) if behavior else df
    w = _windowed(src.select(user, ts), ts, size)
    return w.groupBy("window_start", "window_end").agg(F.count_distinct(user).alias(out))


def uv_bitmap(df: DataFrame, size="1 hour", cap: int = 1 << 30, user: str = "user_id",
              ts: str = "ts", behavior: str | None = "pv", out: str = "uv") -> DataFrame:
    """Distinct bitmap offsets per window (what a ``cap``-bit bitmap counts)."""
    src = df.where(F.col("behavior") == behavior) if behavior else df
    w = _windowed(src.select(bitmap_offset(F.col(user), cap).alias("_off"), ts), ts, size)
    return w.groupBy("window_start", "window_end").agg(F.count_distinct("_off").alias(out))


def uv_running(df: DataFrame, size="1 hour", cap: int | None = 1 << 30, user: str = "user_id",
               ts: str = "ts", seq: str = "seq", behavior: str | None = "pv",
               chunk="1 minute", out: str = "uv") -> DataFrame:
    """One row per input row with its window's distinct count so far.

    Rows are ordered by (ts, seq) and dealt once by (window, minute). Inside
    a minute each member's first row is found; only those meet by
    (window, member), where the first of the whole window becomes a marker
    that goes back to its minute. The running count of the markers is a
    two-level prefix sum, so no task holds a whole window or a hot member.
    Both uses of the dealt rows ask for the same columns, so that the scan
    and the exchange run once.
    """
    src = df.where(F.col("behavior") == behavior) if behavior else df
    ntz = is_ntz(src, ts)
    size_us = to_micros(size)
    member = bitmap_offset(F.col(user), cap) if cap else F.col(user)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    us = epoch_micros(src, ts)
    # never null, so that the join below adds no filter of its own to one of the uses
    never_null = lambda c: F.coalesce(c, F.lit(0))
    rows = (src.where(F.col(ts).isNotNull())
            .select(never_null(floor_div(us, size_us) * F.lit(size_us)).alias("_ws"),
                    never_null(floor_div(us, to_micros(chunk))).alias("_rc"),
                    us.alias("_us"), F.col(seq).alias("_seq"), member.alias("_m"))
            .repartition(parts, "_ws", "_rc"))
    in_minute = Window.partitionBy("_ws", "_rc", "_m").orderBy("_us", "_seq")
    in_window = Window.partitionBy("_ws", "_m").orderBy("_us", "_seq")
    firsts = (rows.withColumn("_n", F.row_number().over(in_minute)).where("_n = 1").drop("_n")
              .withColumn("_new", (F.row_number().over(in_window) == 1).cast("int")))
    markers = firsts.where("_new = 1").repartition(parts, "_ws", "_rc")
    both = rows.withColumn("_new", F.lit(0)).unionByName(markers)
    # at equal (ts, seq) a row's own marker sorts before the row
    order = Window.partitionBy("_ws", "_rc").orderBy("_us", "_seq", F.desc("_new"), "_m")
    ran = both.withColumn("_in", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # every minute with rows has a first row of some member, so every minute is among the offsets
    before = Window.partitionBy("_ws").orderBy("_rc").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (firsts.groupBy("_ws", "_rc").agg(F.sum("_new").alias("_t"))
               .select("_ws", "_rc", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off")))
    return (ran.where("_new = 0").join(offsets, ["_ws", "_rc"])
            .select(F.col("_seq").alias(seq), micros_to_ts(F.col("_us"), ntz).alias(ts),
                    micros_to_ts(F.col("_ws"), ntz).alias("window_start"),
                    micros_to_ts(F.col("_ws") + F.lit(size_us), ntz).alias("window_end"),
                    (F.col("_in") + F.col("_off")).cast("bigint").alias(out)))


def uv_hll(df: DataFrame, size="1 hour", user: str = "user_id", ts: str = "ts",
           behavior: str | None = "pv", lg_config_k: int = 12, out: str = "uv") -> DataFrame:
    """Approximate distinct users with a mergeable HLL sketch per window.

    ``sketch`` can be stored and merged (``hll_union_agg``) into coarser
    windows without rescanning the rows.
    """
    src = df.where(F.col("behavior") == behavior) if behavior else df
    w = _windowed(src.select(user, ts), ts, size)
    return (w.groupBy("window_start", "window_end")
            .agg(F.hll_sketch_agg(user, lg_config_k).alias("sketch"))
            .withColumn(out, F.hll_sketch_estimate("sketch")))


# ------------------------------------------------- mergeable stores

def bitmap_store(df: DataFrame, size="1 hour", cap: int = 1 << 30, user: str = "user_id", ts: str = "ts",
                 behavior: str | None = "pv") -> DataFrame:
    """A7 as a store: (window_start, window_end, bucket, bitmap), one bitmap of 32,768 offsets per row.

    Offsets are cut into buckets, so a window is many small rows and no task
    holds a whole ``cap``-bit map; only buckets with a member exist. Stores
    of other days, files or micro-batches are stacked with ``unionByName``:
    :func:`merge_bitmaps` ors what meets, nothing is scanned again.
    """
    src = df.where(F.col("behavior") == behavior) if behavior else df
    at = bitmap_offset(F.col(user), cap)
    w = _windowed(src.select(at.alias("_off"), ts), ts, size).where(F.col("_off").isNotNull())
    return (w.groupBy("window_start", "window_end", F.bitmap_bucket_number("_off").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_off")).alias("bitmap")))


def merge_bitmaps(store: DataFrame, size=None) -> DataFrame:
    """One row per window and bucket of stacked stores; ``size`` merges into coarser tumbling windows."""
    if size is not None:
        store = _windowed(store.select("window_start", "bucket", "bitmap").withColumnRenamed("window_start", "_at"),
                          "_at", size).drop("_at")
    return store.groupBy("window_start", "window_end", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def uv_from_bitmaps(store: DataFrame, size=None, out: str = "uv") -> DataFrame:
    """Distinct offsets per window of a bitmap store, optionally in coarser windows of ``size``."""
    return (merge_bitmaps(store, size).groupBy("window_start", "window_end")
            .agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(out)))


def sketch_store(df: DataFrame, pane="5 minutes", user: str = "user_id", ts: str = "ts",
                 behavior: str | None = "pv", lg_config_k: int = 12) -> DataFrame:
    """A9 as a store: (window_start, window_end, sketch), one HLL sketch per pane that has rows."""
    return uv_hll(df, pane, user, ts, behavior, lg_config_k, "_est").drop("_est")


def uv_from_sketches(store: DataFrame, size="1 hour", slide=None, out: str = "uv") -> DataFrame:
    """Approximate distinct users in sliding windows, from the panes of one or several stores.

    Panes of equal time (of several stores) are merged first; then each pane
    goes to the windows that hold it. ``size`` and ``slide`` are multiples of
    the panes' width.
    """
    size_us, slide_us = to_micros(size), to_micros(slide if slide is not None else size)
    ntz = is_ntz(store, "window_start")
    panes = (store.groupBy(epoch_micros(store, "window_start").alias("_us")).agg(F.hll_union_agg("sketch").alias("_s")))
    # windows [k slide, k slide + size) with k slide <= us < k slide + size
    k = F.sequence(floor_div(F.col("_us") - F.lit(size_us), slide_us) + 1, floor_div(F.col("_us"), slide_us))
    start = F.col("_k") * F.lit(slide_us)
    return (panes.select("_s", F.explode(k).alias("_k")).groupBy("_k")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("_s")).alias(out))
            .select(micros_to_ts(start, ntz).alias("window_start"),
                    micros_to_ts(start + F.lit(size_us), ntz).alias("window_end"), out))


__all__ = ["uv_exact", "uv_bitmap", "uv_running", "uv_hll", "bitmap_store", "merge_bitmaps", "uv_from_bitmaps",
           "sketch_store", "uv_from_sketches", "window_counts"]
