"""Mergeable stores (A7 bitmaps, A9 sketches), one-pass plans, burst chains."""

import contextlib
import datetime
import io
import random

import pytest
from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.plans import chains
from clickpulse.sources import testdata as td
from tests.conftest import SF_SMALL

EPOCH = datetime.datetime(2024, 1, 1)
LOGIN_SCHEMA = "user_id long, event_type string, ts timestamp_ntz, seq long"


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ A7 / A9

def test_bitmaps_merge_without_rescanning(spark):
    views = td.user_behavior(spark, SF_SMALL, pv_only=True)
    half = F.pmod(F.xxhash64("seq"), F.lit(2))
    parts = [op.bitmap_store(views.where(half == k), "1 hour") for k in (0, 1)]
    store = parts[0].unionByName(parts[1])
    assert _rows(op.uv_from_bitmaps(store)) == _rows(op.uv_bitmap(views, "1 hour"))
    assert _rows(op.uv_from_bitmaps(store, "1 day")) == _rows(op.uv_bitmap(views, "1 day"))
    # merging twice, or the same part again, changes nothing
    again = op.merge_bitmaps(store).unionByName(parts[0])
    assert _rows(op.uv_from_bitmaps(again, "1 day")) == _rows(op.uv_bitmap(views, "1 day"))


def test_bitmap_buckets_and_edges(spark):
    ids = [0, 1, 31, 32, 1 << 20, (1 << 30) - 1, 7]
    rows = [(i, EPOCH + datetime.timedelta(minutes=m), "pv") for m, i in enumerate(ids)] + [(7, EPOCH, "pv"), (None, EPOCH, "pv")]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, behavior string")
    store = op.bitmap_store(df, "1 hour")
    assert _rows(op.uv_from_bitmaps(store)) == _rows(op.uv_bitmap(df, "1 hour"))
    assert store.groupBy("window_start", "bucket").count().where("count > 1").count() == 0
    assert op.uv_from_bitmaps(op.bitmap_store(df.limit(0))).count() == 0


def test_sliding_sketches_within_bound(spark):
    views = td.user_behavior(spark, SF_SMALL, pv_only=True)
    panes = op.sketch_store(views, "15 minutes")
    est = {r.window_start: r.uv for r in op.uv_from_sketches(panes, "2 hours", "30 minutes").collect()}
    exact = (views.select(F.window("ts", "2 hours", "30 minutes").alias("w"), "user_id").groupBy("w.start")
             .agg(F.count_distinct("user_id").alias("uv")).collect())
    assert set(est) == {r.start for r in exact}
    assert all(abs(est[r.start] - r.uv) <= max(1, .065 * r.uv) for r in exact)


def test_sketches_of_two_stores_merge(spark):
    rows = [(u, EPOCH + datetime.timedelta(seconds=u % 7200), "pv") for u in range(20_000)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, behavior string")
    parts = [op.sketch_store(df.where(F.col("user_id") % 3 == k), "5 minutes") for k in range(3)]
    store = parts[0].unionByName(parts[1]).unionByName(parts[2])
    one = op.uv_from_sketches(store, "2 hours", "2 hours").collect()
    assert len(one) == 1 and abs(one[0].uv - 20_000) < .065 * 20_000
    assert one[0].window_start == EPOCH


# ------------------------------------------------------------------ J2 / A8

def _brute_reconcile(pays, receipts, lo, hi):
    out, hit = [], set()
    for k, p in pays:
        got = [(j, r) for j, (k2, r) in enumerate(receipts)
               if k is not None and k == k2 and p is not None and r is not None and p + lo <= r <= p + hi]
        hit |= {j for j, _ in got}
        out += [(k, "matched", p, r) for _, r in got] or [(k, "paid_no_receipt", p, None)]
    return sorted(out + [(k, "receipt_no_pay", None, r) for j, (k, r) in enumerate(receipts) if j not in hit], key=str)


@pytest.mark.parametrize("bounds", [(-3, 5), (0, 0), (2, 4), (-6, -1)])
@pytest.mark.parametrize("bucket", [None, "6 seconds"])
def test_reconcile_equals_nested_loops(spark, bounds, bucket):
    rng = random.Random(str(bounds))

    def side(n):
        return [(rng.choice(["a", "a", "a", "b", "c", None]),
                 EPOCH + datetime.timedelta(seconds=rng.randint(0, 60)) if rng.random() > .05 else None) for _ in range(n)]
    pays, receipts = side(60), side(70)
    lo, hi = (datetime.timedelta(seconds=b) for b in bounds)
    got = op.reconcile(spark.createDataFrame(pays, "tx_id string, pay_ts timestamp_ntz"),
                       spark.createDataFrame(receipts, "tx_id string, receipt_ts timestamp_ntz"),
                       lower=f"{bounds[0]} seconds", upper=f"{bounds[1]} seconds", bucket=bucket)
    assert _rows(got) == _brute_reconcile(pays, receipts, lo, hi)


def test_reconcile_scans_each_table_once_and_joins_nothing(spark):
    import __spark_entry__ as entry
    plan = _plan(entry.queries()["order_receipt_reconcile"](spark, SF_SMALL))
    assert plan.count("FileScan") == 2 and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_running_uv_reuses_one_exchange_of_the_rows(spark, tmp_path):
    views = td.user_behavior(spark, SF_SMALL, pv_only=True)
    df = op.uv_running(views)
    df.write.mode("overwrite").parquet(str(tmp_path / "out"))
    df.collect()
    plan = _plan(df)
    final = plan.split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    assert df.count() == views.count()


def test_running_uv_of_hot_members_and_empty_minutes(spark):
    rng = random.Random(4)
    rows = sorted((rng.randint(0, 7199), q, rng.choice([1, 1, 1, rng.randint(2, 60)])) for q in range(1500))
    rows = [(u, EPOCH + datetime.timedelta(seconds=s), q, "pv") for s, q, u in rows if not 1000 < s < 1400]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, seq long, behavior string")
    want, seen = {}, {}
    for u, t, q, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        members = seen.setdefault(t.replace(minute=0, second=0), set())
        members.add(u)
        want[q] = len(members)
    assert {r.seq: r.uv for r in op.uv_running(df, cap=None).collect()} == want


def test_columns_named_like_working_columns(spark):
    left = spark.createDataFrame([("a", EPOCH, 1, 2)], "tx string, p timestamp_ntz, _b int, _lus int")
    right = spark.createDataFrame([("a", EPOCH, 3)], "tx string, r timestamp_ntz, _rus int")
    got = op.interval_join(left, right, ["tx"], "p", "r").collect()
    assert [(r.tx, r._b, r._lus, r._rus) for r in got] == [("a", 1, 2, 3)]


# ------------------------------------------------------------------ F3

def _brute_bursts(rows, within, least):
    out, by_user = [], {}
    for u, kind, t, q in rows:
        by_user.setdefault(u, []).append((t, q, kind == "fail"))
    for u, events in by_user.items():
        group = []
        for t, _, fail in sorted(events):
            if group and t - group[0] > within:
                out.append((u, group[0], group[-1], len(group))) if len(group) >= least else None
                group = []
            if not fail:
                group = []
            else:
                group.append(t)
        if len(group) >= least:
            out.append((u, group[0], group[-1], len(group)))
    return sorted(out)


@pytest.mark.parametrize("fan_out", [2, 64])
def test_bursts_over_chunks_and_blocks(spark, monkeypatch, fan_out):
    monkeypatch.setattr(chains, "FAN_OUT", fan_out)
    rng = random.Random(fan_out)
    rows = []
    for u in range(6):
        t = 0
        for _ in range(300):
            t += rng.choice([0, 1, 1, 2, 3] if u else [1, 2])
            rows.append((u, "fail" if rng.random() < (.97 if u < 3 else .6) else "success",
                         EPOCH + datetime.timedelta(seconds=t), len(rows)))
    df = spark.createDataFrame(rows, LOGIN_SCHEMA)
    got = op.login_fail_bursts(df, "3 seconds", chunk="24 seconds")
    assert sorted(map(tuple, got.collect())) == _brute_bursts(rows, datetime.timedelta(seconds=3), 2)
    assert op.login_fail_bursts(df.limit(0), "3 seconds").count() == 0


def test_one_user_with_200000_fails_and_no_job_while_building(spark):
    n = 200_000
    fails = (spark.range(n).select(F.lit(1).cast("bigint").alias("user_id"), F.lit("fail").alias("event_type"),
                                   (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
                                    + F.expr("make_dt_interval(0, 0, 0, id)")).alias("ts"), F.col("id").alias("seq")))
    sc = spark.sparkContext
    sc.setJobGroup("building", "no job may run")
    bursts = op.login_fail_bursts(fails, "2 seconds")
    assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    sc.setJobGroup("", "")
    # a group holds the fails at 0, 1 and 2 seconds, the next one starts at 3
    r = bursts.agg(F.count(F.lit(1)).alias("n"), F.min("n_fails").alias("low"), F.sum("n_fails").alias("all")).first()
    assert (r.n, r.low, r["all"]) == (n // 3 + 1, 2, n)
