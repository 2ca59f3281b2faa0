"""Plan equivalences and invariants on the driver tables."""

import datetime

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.functions.hashing import bitmap_offset
from clickpulse.plans.chunks import running_by_chunk, with_halo
from clickpulse.plans.sliding import window_counts
from clickpulse.sources import testdata as td
from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pane_plan_equals_window(spark):
    log = td.access_log(spark, SF_SMALL)
    for size, slide in [("10 minutes", "5 seconds"), ("1 hour", "5 minutes"),
                        ("25 minutes", "10 minutes"), ("7 minutes", "3 minutes")]:
        a = window_counts(log, "ts", ["url"], size, slide, plan="pane")
        b = window_counts(log, "ts", ["url"], size, slide, plan="direct")
        assert _same(a, b), (size, slide)


def test_sliding_total_is_overlaps_times_rows(spark):
    ub = td.user_behavior(spark, SF_SMALL).where("behavior = 'pv'")
    n = ub.count()
    c = op.item_counts(ub, "1 hour", "5 minutes")
    assert c.agg(F.sum("cnt")).first()[0] == 12 * n


def test_row_order_does_not_matter(spark):
    lg = td.logins(spark, SF_SMALL)
    shuffled = lg.repartition(7, F.rand(3))
    for f in [lambda d: op.consecutive_fails(d, "6 hours"),
              lambda d: op.login_fail_bursts(d, "12 hours"),
              lambda d: op.fails_times_n(d, 3, "1 day")]:
        assert _same(f(lg), f(shuffled))


def test_halo_chunk_width_does_not_matter(spark):
    lg = td.logins(spark, SF_SMALL)
    base = op.consecutive_fails(lg, "6 hours")
    for chunk in ["6 hours", "1 day", "30 days"]:
        assert _same(base, op.consecutive_fails(lg, "6 hours", chunk=chunk))
    ob = td.order_events(spark, SF_SMALL)
    st0 = op.order_pay_states(ob, "150 days")
    assert _same(st0, op.order_pay_states(ob, "150 days", chunk="3000 days"))


def test_halo_copies(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, 0, s),) for s in [0, 1, 9, 10]],
                               "ts timestamp_ntz")
    h = with_halo(df, "ts", 10_000_000, lookahead_us=1_000_000, lookback_us=1_000_000)
    got = sorted((r._chunk - h.agg(F.min("_chunk")).first()[0], r._own) for r in h.collect())
    # 0s: own in c0 and halo of c-1; 1s: own + halo of c-1; 9s: own + lookback halo of c1;
    # 10s: own in c1 + halo of c0
    assert len(got) == 8


def test_running_by_chunk_matches_window(spark):
    rows = [(i % 3, i * 7 % 50, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, _t long, v long")
    r = running_by_chunk(df, ["k"], "_t", ["_t", "v"], "v", 10, "run")
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy("_t", "v").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("run", F.sum("v").over(w))
    assert _same(r.select("k", "_t", "v", "run"), exp)


@settings(max_examples=30, deadline=None)
@given(st.integers(min_value=0, max_value=10**12))
def test_bitmap_offset_matches_polynomial(spark_session_uid, n):
    s = str(n)
    r = 0
    for ch in s:
        r = (r * 32 + ord(ch)) & ((1 << 30) - 1)
    assert spark_session_uid(s) == r


def test_bitmap_collision_example(spark):
    df = spark.createDataFrame([("1234567",), ("234567",)], "u string")
    vals = [r.o for r in df.select(bitmap_offset("u").alias("o")).collect()]
    assert vals[0] == vals[1] == 659217143


def test_window_plans_give_equal_values_and_types(spark):
    """Sums of doubles, decimals and longs: both plans, and the default at any overlap."""
    from clickpulse.plans.sliding import window_counts
    rows = spark.sql("""SELECT k, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, m) AS ts,
                               w AS d, cast(w AS decimal(12, 2)) AS c, cast(w * 4 AS bigint) AS l, cast(w * 4 AS int) AS i
                        FROM VALUES (1, 3, 0.75D), (1, 50, 0.5D), (2, 61, 0.25D), (1, 130, null) AS t(k, m, w)""")
    for weight in (None, "d", "c", "l", "i"):
        got = {}
        for plan in ("direct", "pane", "auto"):
            for slide in ("1 hour", "20 minutes", "5 minutes"):
                df = window_counts(rows, "ts", ["k"], "1 hour", slide, weight=weight, plan=plan)
                got.setdefault(slide, []).append((df.schema["cnt"].dataType, sorted(map(str, df.collect()))))
        for slide, results in got.items():
            assert results[0] == results[1] == results[2], (weight, slide)
    total = window_counts(rows, "ts", ["k"], "1 hour", weight="d", plan="pane").where("k = 1").orderBy("window_start")
    assert [r.cnt for r in total.collect()] == [1.25, None]
