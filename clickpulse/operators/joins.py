"""Interval join (J1) and pay/receipt reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.timefn import epoch_micros, to_micros
from clickpulse.plans.chunks import CHUNK, OWN, US, chunk_width, halo_copies
from clickpulse.plans.names import unused
from clickpulse.plans.sliding import floor_div


def interval_join(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str,
                  lower="-3 seconds", upper="5 seconds", bucket=None) -> DataFrame:
    """Inner join on ``on`` with ``right_ts`` in [left_ts + lower, left_ts + upper].

    Bounds are inclusive. Both sides are also keyed by a time bucket of width
    ``bucket`` (default upper - lower); each right row is copied into the at
    most two buckets its match range can touch. A hot key is thus split by
    time across tasks instead of meeting all its partners in one task.
    Column names other than ``on`` must differ between the sides.
    """
    lo, hi = to_micros(lower), to_micros(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    b = max(to_micros(bucket) if bucket is not None else hi - lo, 1)
    bucket_col, l_us, r_us = (unused(n, left, right) for n in ("_b", "_lus", "_rus"))
    l2 = (left.withColumn(l_us, epoch_micros(left, left_ts))
          .withColumn(bucket_col, floor_div(F.col(l_us), b)))
    # lefts that can match a right row at r lie in [r - hi, r - lo]
    r2 = (right.withColumn(r_us, epoch_micros(right, right_ts))
          .withColumn(bucket_col, F.explode(F.sequence(floor_div(F.col(r_us) - F.lit(hi), b),
                                                       floor_div(F.col(r_us) - F.lit(lo), b)))))
    cond = [l2[k] == r2[k] for k in on] + [
        l2[bucket_col] == r2[bucket_col],
        r2[r_us] >= l2[l_us] + F.lit(lo),
        r2[r_us] <= l2[l_us] + F.lit(hi),
    ]
    j = l2.join(r2, on=cond, how="inner")
    lcols = [l2[c] for c in left.columns]
    rcols = [r2[c] for c in right.columns if c not in on]
    return j.select(*lcols, *rcols)


def reconcile(pays: DataFrame, receipts: DataFrame, on: str = "tx_id", pay_ts: str = "pay_ts",
              receipt_ts: str = "receipt_ts", lower="-3 seconds", upper="5 seconds",
              bucket=None, dedupe_tx: bool = False) -> DataFrame:
    """Matched / paid_no_receipt / receipt_no_pay, tagged in one DataFrame.

    One pass and one exchange: both sides are stacked and dealt by
    (key, time chunk), rows near a chunk's edge copied into the neighbour
    chunk. In a chunk's time order the receipts of a pay are the range
    [pay + lower, pay + upper], and a receipt without a pay in the mirrored
    range is alone. A hot key is split by time; a range holds no more rows
    than the pairs it gives. Rows without key or time match nothing.
    ``bucket`` sets the chunk width (at least the longer bound).
    ``dedupe_tx=True`` first keeps the earliest pay and the earliest receipt
    of each key, so that a key matches one to one.
    """
    lo, hi = to_micros(lower), to_micros(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    if dedupe_tx:
        pays = pays.groupBy(on).agg(F.min(pay_ts).alias(pay_ts))
        receipts = receipts.groupBy(on).agg(F.min(receipt_ts).alias(receipt_ts))
    no_pay = F.lit(None).cast(pays.schema[pay_ts].dataType)
    no_receipt = F.lit(None).cast(receipts.schema[receipt_ts].dataType)
    both = (pays.select(F.col(on).alias("_k"), epoch_micros(pays, pay_ts).alias(US), F.lit(True).alias("_pay"),
                        F.col(pay_ts).alias("_p"), no_receipt.alias("_r"))
            .unionByName(receipts.select(F.col(on).alias("_k"), epoch_micros(receipts, receipt_ts).alias(US),
                                         F.lit(False).alias("_pay"), no_pay.alias("_p"),
                                         F.col(receipt_ts).alias("_r"))))
    reach = max(abs(lo), abs(hi))
    width = chunk_width(reach, to_micros(bucket) if bucket is not None else max(4 * reach, to_micros("1 minute")))
    here = Window.partitionBy("_k", CHUNK).orderBy(US)
    known = F.col("_k").isNotNull() & F.col(US).isNotNull()
    partners = F.collect_list(F.when(~F.col("_pay") & known, F.struct("_r"))).over(here.rangeBetween(lo, hi))
    pays_near = F.count(F.when(F.col("_pay") & known, 1)).over(here.rangeBetween(-hi, -lo))

    def row(status: str, receipt):
        return F.struct(F.lit(status).alias("s"), receipt.alias("r"))

    result = (F.when(F.col("_pay") & (F.size("_rs") > 0), F.transform("_rs", lambda x: row("matched", x["_r"])))
              .when(F.col("_pay"), F.array(row("paid_no_receipt", no_receipt)))
              .when(F.col("_np") == 0, F.array(row("receipt_no_pay", F.col("_r")))))
    return (halo_copies(both, width, reach, reach)
            .withColumn("_rs", partners).withColumn("_np", pays_near).where(OWN)
            .select(F.col("_k").alias(on), F.col("_p").alias(pay_ts), F.explode(result).alias("_x"))
            .select(on, F.col("_x.s").alias("status"), pay_ts, F.col("_x.r").alias(receipt_ts)))
