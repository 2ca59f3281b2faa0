"""Top-N per window (R1-R3) and the text report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpulse.functions.timefn import interval_str, to_micros
from clickpulse.operators.windows import item_counts, url_counts


def top_n(counts: DataFrame, key_cols: list[str], n: int = 5, count_col: str = "cnt",
          part: tuple[str, ...] = ("window_start", "window_end"), rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n per window by count desc; ties by key ascending.

    ``row_number() <= n`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so at most n rows per window leave each map task even
    when one window holds most of the keys.
    """
    w = Window.partitionBy(*part).orderBy(F.desc(count_col), *[F.asc(k) for k in key_cols])
    return counts.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def hot_items(ub: DataFrame, n: int = 5, size="1 hour", slide="5 minutes", **kw) -> DataFrame:
    """Top-n items per sliding window."""
    return top_n(item_counts(ub, size, slide, **kw), ["item_id"], n)


def hot_urls(log: DataFrame, n: int = 5, size="10 minutes", slide="5 seconds", **kw) -> DataFrame:
    """R2: top-n URLs per sliding window."""
    return top_n(url_counts(log, size, slide, **kw), ["url"], n)


def hot_items_sql(spark: SparkSession, ub: DataFrame, n: int = 5, size="1 hour",
                  slide="5 minutes") -> DataFrame:
    """The same report written in SQL (the DataFrame is bound into the
    query text, so no session-global temp view is registered)."""
    size_s, slide_s = interval_str(to_micros(size)), interval_str(to_micros(slide))
    return spark.sql(f"""
        WITH counts AS (
          SELECT item_id, window.start AS window_start, window.end AS window_end, count(*) AS cnt
          FROM {{ub}}
          WHERE behavior = 'pv'
          GROUP BY window(ts, '{size_s}', '{slide_s}'), item_id
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY window_start, window_end
                                       ORDER BY cnt DESC, item_id) AS rank
          FROM counts
        )
        SELECT item_id, window_start, window_end, cnt, rank FROM ranked WHERE rank <= {int(n)}
    """, ub=ub)


def render_topn(topn: DataFrame, key_col: str, label: str, count_col: str = "cnt",
                rank_col: str = "rank") -> DataFrame:
    """One text report per window (``window_end``, ``report``).

    Each window holds at most n ranked rows, so the per-window list is bounded.
    """
    entries = F.array_sort(F.collect_list(F.struct(rank_col, key_col, count_col)))
    lines = F.transform(entries, lambda e: F.format_string(
        f"No%d: {label}=%s count=%d", e[rank_col], e[key_col].cast("string"), e[count_col]))
    header = F.concat(F.lit("window end: "), F.col("window_end").cast("string"))
    return (topn.groupBy("window_end")
            .agg(F.concat_ws("\n", F.array_prepend(lines, header)).alias("report")))
