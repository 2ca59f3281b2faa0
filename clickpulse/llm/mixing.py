"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are cut into blocks. In a mix with integer weights ``a`` of
sum ``L`` the k-th block of a source is released at floor(k L / a) and due at
ceil((k + 1) L / a); earliest deadline first fills one slot after the other,
so at every slot each source is less than one block away from its share. The
schedule repeats after ``L`` slots: it is worked out for one period, and every
block finds its slot by arithmetic, all blocks at once.

When a source runs out, the remaining ones go on with their weights (a new
phase), until every row has its place.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from fractions import Fraction
from math import gcd, lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import shielded, without

#: Rows per block, and the largest number of slots in a period (bounds the schedule).
BLOCK_ROWS = 64
MAX_PERIOD = 100_000
#: Weight of the sources without one, where none is given: this part of the sum.
OTHER_PART = 1000
#: Rows that one ranking task handles; the class of sources without a weight.
RANK_ROWS = 20_000
OTHER = "*"


def _exact(weight: float) -> Fraction:
    near = Fraction(weight).limit_denominator(10 ** 6)
    return near if float(near) == weight else Fraction(str(weight))


def integer_weights(weights: dict[str, float], most: int = MAX_PERIOD) -> dict[str, int]:
    """Positive weights as integers in exactly their proportions, if these sum to at most ``most``.

    Otherwise they are rounded to parts of ``most``: a source then drifts from
    its target by up to one block in 2 x ``most`` slots, and one with a share
    below 1 / ``most`` gets that share.
    """
    given = {s: _exact(w) for s, w in weights.items() if w > 0}
    scale = lcm(*(w.denominator for w in given.values())) if given else 1
    parts = {s: int(w * scale) for s, w in given.items()}
    g = gcd(*parts.values())
    if sum(parts.values()) > most * g:
        total = sum(given.values())
        parts = {s: max(1, round(w / total * most)) for s, w in given.items()}
        g = gcd(*parts.values())
    return {s: p // g for s, p in parts.items()}


def edf_period(a: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks within one period, earliest deadline first."""
    period = sum(a.values())
    slots: dict[str, list[int]] = {s: [] for s in a}
    later, ready = [(0, s) for s in sorted(a)], []      # by release, by deadline
    for t in range(period):
        while later and later[0][0] <= t:
            _, s = heapq.heappop(later)
            heapq.heappush(ready, (-(-(len(slots[s]) + 1) * period // a[s]), s))
        _, s = heapq.heappop(ready)
        slots[s].append(t)
        if len(slots[s]) < a[s]:
            heapq.heappush(later, (len(slots[s]) * period // a[s], s))
    return slots


@dataclass
class Phase:
    start_slot: int
    first: dict[str, int]       # block with which each source enters the phase
    slots: dict[str, list[int]]
    period: int


def phases(blocks: dict[str, int], a: dict[str, int]) -> list[Phase]:
    """One phase per source at most: each ends with the last block of a source."""
    first, start, out = dict.fromkeys(blocks, 0), 0, []
    while live := {s: a[s] for s in blocks if blocks[s] > first[s]}:
        g = 0
        for x in live.values():
            g = gcd(g, x)
        live = {s: x // g for s, x in live.items()}
        period, slots = sum(live.values()), edf_period(live)
        out.append(Phase(start, dict(first), slots, period))
        last = {s: blocks[s] - first[s] - 1 for s in live}
        end = min((k // live[s]) * period + slots[s][k % live[s]] + 1 for s, k in last.items())
        for s in live:
            first[s] += (end // period) * live[s] + sum(x < end % period for x in slots[s])
        start += end
    return out


def _rank(docs: DataFrame, klass: str, order: str, n_rows: int) -> DataFrame:
    """``__rank`` from 0 within each class by ``order`` (hex text) and ``__tie``, in two levels.

    The leading hex digits deal a class to buckets of about ``RANK_ROWS``
    rows; a bucket's rows are numbered after all rows of the buckets before.
    """
    digits = 1
    while 16 ** digits * RANK_ROWS < n_rows and digits < 6:
        digits += 1
    docs = docs.withColumn("__bucket", F.substring(order, 1, digits))
    before = Window.partitionBy(klass).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = docs.groupBy(klass, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(F.col(klass).alias("__k"), F.col("__bucket").alias("__b"),
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(klass, "__bucket").orderBy(order, "__tie")
    numbered = docs.withColumn("__i", F.row_number().over(inside) - 1)
    # the numbered rows are already dealt by class and bucket: only the counts move
    return (numbered.join(offsets, (F.col(klass) == F.col("__k")) & (F.col("__bucket") == F.col("__b")))
            .withColumn("__rank", F.col("__before") + F.col("__i")).drop("__k", "__b", "__i", "__before", "__bucket"))


@shielded
def mix_sources(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", source_col: str = "source",
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row of ``docs`` plus ``mix_class, mix_phase, mix_block, mix_slot, mix_position``.

    ``weights`` maps sources to target weights; the key ``*`` is the weight of
    all sources that have none of their own, null included, taken as one class
    (without it they share ``1 / OTHER_PART`` of the sum). Within a class rows
    come in the order of md5(id). ``mix_position`` orders the mix: slot times
    ``block_rows`` plus the place in the block (the last block of a class may
    be short, so positions can have gaps). Phase 0 holds the full target mix;
    each later phase starts where a class has run out, and no row is dropped
    or repeated. Ties: rows with equal ids follow each other by the hash of
    all columns, and equal rows are interchangeable. Null ids come as the text
    ``null``. An empty table gives an empty result; input columns named like
    an output column are replaced.
    """
    spark = docs.sparkSession
    docs = without(docs, "mix_class", "mix_phase", "mix_block", "mix_slot", "mix_position")
    cols = docs.columns
    known = {s: w for s, w in weights.items() if w > 0}
    known.setdefault(OTHER, sum(known.values()) / OTHER_PART if known else 1.0)
    a = integer_weights(known)
    named = [s for s in a if s != OTHER]
    klass: Column = F.when(F.col(source_col).isin(named), F.col(source_col)).otherwise(F.lit(OTHER)) \
        if named else F.lit(OTHER)
    work = (docs.withColumn("mix_class", klass)
            .withColumn("__order", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
            .withColumn("__tie", F.xxhash64(*cols)))
    sizes = {r.mix_class: r.n for r in work.groupBy("mix_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = phases({s: -(-n // block_rows) for s, n in sizes.items()}, a)
    # a row per class and phase, and one per block of its period that the phase reaches: small tables
    ends = [p.first for p in plan[1:]] + [dict.fromkeys(a, 1 << 62)]
    spans = spark.createDataFrame(
        [(s, k, p.first[s], ends[k][s], p.start_slot, p.period, len(at))
         for k, p in enumerate(plan) for s, at in p.slots.items()],
        "__c string, __phase int, __first bigint, __next bigint, __start bigint, __period bigint, __per bigint")
    used = [(s, k, at[:ends[k][s] - p.first[s]] if k + 1 < len(plan) else at[:-(-sizes[s] // block_rows) - p.first[s]])
            for k, p in enumerate(plan) for s, at in p.slots.items()]
    places = spark.createDataFrame(pa.table({
        "__c2": pa.array([s for s, _, at in used for _ in at], pa.string()),
        "__phase2": pa.array([k for _, k, at in used for _ in at], pa.int32()),
        "__j": pa.array([j for _, _, at in used for j in range(len(at))], pa.int64()),
        "__at": pa.array([x for _, _, at in used for x in at], pa.int64())}))
    ranked = _rank(work, "mix_class", "__order", sum(sizes.values())).withColumn(
        "mix_block", F.expr(f"__rank div {block_rows}"))
    spanned = ranked.join(F.broadcast(spans), (F.col("mix_class") == F.col("__c"))
                          & (F.col("mix_block") >= F.col("__first")) & (F.col("mix_block") < F.col("__next")))
    met = spanned.join(F.broadcast(places), (F.col("__c") == F.col("__c2")) & (F.col("__phase") == F.col("__phase2"))
                       & ((F.col("mix_block") - F.col("__first")) % F.col("__per") == F.col("__j")))
    slot = F.expr("__start + ((mix_block - __first) div __per) * __period + __at")
    return (met.withColumn("mix_phase", F.col("__phase")).withColumn("mix_slot", slot)
            .withColumn("mix_position", F.col("mix_slot") * block_rows + F.col("__rank") % block_rows)
            .select(*cols, "mix_class", "mix_phase", "mix_block", "mix_slot", "mix_position"))
