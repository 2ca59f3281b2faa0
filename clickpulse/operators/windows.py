"""Windowed counts: items, URLs, channels, page views (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.plans.skew import salted_count
from clickpulse.plans.sliding import tumbling_bounds, window_counts


def item_counts(ub: DataFrame, size="1 hour", slide="5 minutes", behavior: str | None = "pv",
                ts: str = "ts", key: str = "item_id", plan: str = "auto") -> DataFrame:
    """A1: sliding count per item -> item_id, window_start, window_end, cnt."""
    src = ub.where(F.col("behavior") == behavior) if behavior else ub
    return window_counts(src.select(key, ts), ts, [key], size, slide, plan=plan)


def url_counts(log: DataFrame, size="10 minutes", slide="5 seconds", method: str | None = "GET",
               ts: str = "ts", plan: str = "auto") -> DataFrame:
    """A2: sliding count per URL of GET requests -> url, window_start, window_end, cnt."""
    src = log.where(F.col("method") == method) if method else log
    return window_counts(src.select("url", ts), ts, ["url"], size, slide, plan=plan)


def channel_behavior_counts(mk: DataFrame, size="1 hour", slide="5 seconds", ts: str = "ts",
                            plan: str = "auto") -> DataFrame:
    """A3: sliding count per (channel, behavior)."""
    return window_counts(mk.select("channel", "behavior", ts), ts, ["channel", "behavior"],
                         size, slide, plan=plan)


def page_views(ub: DataFrame, size="1 hour", behavior: str | None = "pv", ts: str = "ts",
               out: str = "pv") -> DataFrame:
    """A5: page views per tumbling window -> window_start, window_end, pv."""
    src = ub.where(F.col("behavior") == behavior) if behavior else ub
    return window_counts(src.select(ts), ts, [], size, size, out=out)


def page_views_salted(ub: DataFrame, size="1 hour", behavior: str | None = "pv", ts: str = "ts",
                      salt_by: str = "seq", buckets: int = 8, out: str = "pv") -> DataFrame:
    """A5, explicit two-phase form: count by (salt, window), then sum by window.

    A global (un-keyed) window has one reduce key per window; the salt
    spreads each window's reduce work over ``buckets`` tasks.
    """
    src = ub.where(F.col("behavior") == behavior) if behavior else ub
    start, end = tumbling_bounds(src, ts, size)
    keyed = src.select(start.alias("window_start"), end.alias("window_end"), salt_by)
    return salted_count(keyed, ["window_start", "window_end"], salt_by, buckets, out)
