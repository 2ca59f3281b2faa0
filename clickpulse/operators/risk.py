"""Ad-click blacklist (F1, F2) and per-province ad counts (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.timefn import local_day
from clickpulse.plans.sliding import window_counts


def rank_clicks(clicks: DataFrame, max_clicks: int = 100, user: str = "user_id",
                ad: str = "ad_id", ts: str = "ts", seq: str = "seq",
                utc_offset_hours: int = 8) -> DataFrame:
    """Tag each (user, ad, local day) click with its ordinal ``click_no``.

    Keeps only clicks up to the warning click: clicks 1..max-1 pass, the
    ``max``-th raises the warning, later ones are dropped. The first click is
    never tested, so the warning comes at click ``max(max_clicks, 2)``.
    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` ahead
    of the shuffle: a user clicking one ad millions of times ships at most k
    rows per map task.
    """
    warn_at = max(int(max_clicks), 2)
    w = Window.partitionBy(user, ad, "day").orderBy(ts, seq)
    return (clicks.withColumn("day", local_day(clicks, ts, utc_offset_hours))
            .withColumn("click_no", F.row_number().over(w))
            .where(F.col("click_no") <= warn_at)
            .withColumn("tag", F.when(F.col("click_no") < warn_at, F.lit("passed"))
                        .otherwise(F.lit("blacklist"))))


def clicks_passed(clicks: DataFrame, max_clicks: int = 100, **kw) -> DataFrame:
    """the clicks that get through the blacklist filter."""
    return (rank_clicks(clicks, max_clicks, **kw).where(F.col("tag") == "passed")
            .drop("tag", "click_no", "day"))


def blacklist_warnings(clicks: DataFrame, max_clicks: int = 100, user: str = "user_id",
                       ad: str = "ad_id", ts: str = "ts", **kw) -> DataFrame:
    """one warning per (user, ad, local day) at the blacklisting click."""
    r = rank_clicks(clicks, max_clicks, user=user, ad=ad, ts=ts, **kw)
    return r.where(F.col("tag") == "blacklist").select(
        user, ad, "day", F.col(ts).alias("warn_ts"), F.lit("blacklisted").alias("warning"))


def province_counts(passed: DataFrame, size="1 hour", slide="5 seconds", ts: str = "ts",
                    plan: str = "auto") -> DataFrame:
    """Sliding counts per province of clicks that carry one."""
    return window_counts(passed.select("province", ts), ts, ["province"], size, slide, plan=plan)


def ad_counts_by_province(clicks: DataFrame, max_clicks: int = 100, size="1 hour",
                          slide="5 seconds", ts: str = "ts", plan: str = "auto", **kw) -> DataFrame:
    """A4: sliding click counts per province over the clicks that passed."""
    return province_counts(clicks_passed(clicks, max_clicks, ts=ts, **kw), size, slide, ts, plan)
