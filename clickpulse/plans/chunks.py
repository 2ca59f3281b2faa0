"""Skew-safe plans for keyed, ordered (sequential) logic.

A window function partitioned by a business key alone sends all rows of a
hot key -- possibly a third of the table -- to one task. The operators in
this package instead partition by ``(key, time chunk)``:

* **Halo chunks** (``with_halo``): when a row only needs rows within a
  bounded time distance (pattern ``within``, timeouts, interval bounds),
  each chunk also receives copies of the neighbouring rows that lie within
  that distance of its edges. The rows of a partition are then a contiguous
  slice of the key's time order, so ``lag``/``lead``/running frames give
  exact answers for the chunk's own rows. Chunk width >= the distance, so a
  row is copied at most once in each direction.
* **Two-level prefix** (``running_by_chunk``): unbounded running sums or
  maxima are computed inside each chunk, plus an offset from the per-chunk
  totals of earlier chunks (a small table: one row per non-empty chunk).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.timefn import epoch_micros
from clickpulse.plans.sliding import floor_div

US = "_us"
CHUNK = "_chunk"
OWN = "_own"


def chunk_width(distance_us: int, hint_us: int) -> int:
    return max(int(distance_us), int(hint_us), 1)


def with_halo(df: DataFrame, ts: str, chunk_us: int, lookahead_us: int = 0,
              lookback_us: int = 0) -> DataFrame:
    """Add ``_us`` (epoch micros), ``_chunk`` and ``_own``.

    A row of chunk c is also emitted, with ``_own = false``, into chunk c-1
    if it lies within ``lookahead_us`` of c's start, and into chunk c+1 if
    it lies within ``lookback_us`` of c's end.
    """
    return halo_copies(df.withColumn(US, epoch_micros(df, ts)), chunk_us, lookahead_us, lookback_us)


def halo_copies(base: DataFrame, chunk_us: int, lookahead_us: int = 0, lookback_us: int = 0) -> DataFrame:
    """:func:`with_halo` for rows that already carry ``_us``. A row without time stays in a chunk of its own kind."""
    if chunk_us < max(lookahead_us, lookback_us):
        raise ValueError("chunk width must cover the halo distance")
    c = floor_div(F.col(US), chunk_us)
    off = F.col(US) - c * F.lit(chunk_us)
    copies = [F.struct(c.alias("c"), F.lit(True).alias("o"))]
    if lookahead_us > 0:
        copies.append(F.when(off <= F.lit(lookahead_us),
                             F.struct((c - 1).alias("c"), F.lit(False).alias("o"))))
    if lookback_us > 0:
        copies.append(F.when(F.lit(chunk_us) - off <= F.lit(lookback_us),
                             F.struct((c + 1).alias("c"), F.lit(False).alias("o"))))
    arr = F.filter(F.array(*copies), lambda x: x.isNotNull())
    return (base.withColumn("_cp", F.explode(arr))
            .withColumn(CHUNK, F.col("_cp.c")).withColumn(OWN, F.col("_cp.o"))
            .drop("_cp"))


def running_by_chunk(df: DataFrame, part: list[str], us: str, order: list, value: str,
                     chunk_us: int, out: str, how: str = "sum") -> DataFrame:
    """``out`` = running sum (or max) of ``value`` over ``part`` in ``order``.

    ``order`` must start with the epoch-micros column ``us`` so chunks are
    contiguous in it. Work is partitioned by (part, chunk); the per-chunk
    offsets are a window over one row per non-empty chunk.
    """
    agg = F.sum if how == "sum" else F.max
    d = df.withColumn("_rc", floor_div(F.col(us), chunk_us))
    inner = Window.partitionBy(*part, "_rc").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_in", agg(value).over(inner))
    # Chunk totals: a grouped aggregate whose map-side partial aggregation
    # ships one row per (part, chunk) per task. The row-level data is
    # shuffled once, for the window; the offsets (one row per chunk) join
    # back on the same keys, so that side is broadcast or shuffled alone.
    totals = d.groupBy(*part, "_rc").agg(agg(value).alias("_t"))
    prev = Window.partitionBy(*part).orderBy("_rc").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, "_rc", agg("_t").over(prev).alias("_off"))
    d = d.join(offsets, on=[*part, "_rc"], how="inner")
    if how == "sum":
        res = F.col("_in") + F.coalesce(F.col("_off"), F.lit(0))
    else:
        res = F.greatest(F.col("_in"), F.col("_off"))
    return d.withColumn(out, res).drop("_rc", "_in", "_off")
