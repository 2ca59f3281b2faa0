"""Streams whose state is split or bounded: chunked patterns, pane rings, fired windows, top-N state, running UV.

Rows are delayed at random by less than the watermark delay and replayed in
several micro-batches; results must equal the batch operators or a plain
simulation.
"""

import datetime
import os
import random
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse import streaming as st
from clickpulse.plans.chunks import CHUNK, OWN, halo_copies
from clickpulse.sources import read_ad_clicks
from clickpulse.sources import testdata as td
from clickpulse.streaming.chunked import fail_sequences, order_states, pays_after_creates, reconciled
from tests.conftest import SF_SMALL, fixture
from tests.test_streaming import FAR, _epochs, _same
from tests.test_streaming_order import disordered, replay

EPOCH = datetime.datetime(2024, 1, 1)
LOGIN_SCHEMA = "user_id long, event_type string, ts timestamp_ntz, seq long"
ORDER_SCHEMA = "order_id long, event_type string, ts timestamp_ntz, seq long"


def at(seconds):
    return EPOCH + datetime.timedelta(seconds=float(seconds))


# --------------------------------------------------- F4-F9 by (key, chunk)

def hot_logins(seed, n=900):
    """One user holds a third of the rows."""
    rng = random.Random(seed)
    rows, t = [], 0.0
    for q in range(n):
        t += rng.choice([0, .5, 1, 1, 2])
        rows.append((1 if rng.random() < .34 else rng.randint(2, 60), rng.choice(["fail", "fail", "success"]), at(t), q))
    return pd.DataFrame(rows, columns=["user_id", "event_type", "ts", "seq"])


@pytest.mark.parametrize("n,consecutive", [(2, True), (3, False)])
def test_fail_sequences_by_chunk(spark, n, consecutive):
    df = spark.createDataFrame(hot_logins(n), LOGIN_SCHEMA)
    parts = disordered(df, 5, 4, n, {"user_id": -1, "event_type": "success"})
    out = replay(spark, parts, LOGIN_SCHEMA,
                 lambda s: st.fail_sequence_stream(s, n, "3 seconds", consecutive, "5 seconds", chunk="20 seconds"))
    want = op.fails_times_n(df, n, "3 seconds", consecutive)
    cols = ["user_id", "first_seq", "first_ts", "last_seq", "last_ts"]
    assert _same(_epochs(out, cols), _epochs(want, cols)) and want.where("user_id = 1").count() > 5


def hot_orders(seed, n=700):
    rng = random.Random(seed)
    rows, t = [], 0.0
    for q in range(n):
        t += rng.choice([0, 1, 5, 20, 60])
        rows.append((1 if rng.random() < .34 else rng.randint(2, 40), rng.choice(["create", "pay", "pay", "other"]), at(t), q))
    return pd.DataFrame(rows, columns=["order_id", "event_type", "ts", "seq"])


@pytest.mark.parametrize("kind", ["cep", "states"])
def test_order_patterns_by_chunk(spark, kind):
    stream, batch, cols = {
        "cep": (lambda s: st.order_pay_cep_stream(s, "2 minutes", "60 seconds", chunk="5 minutes"),
                lambda b: op.order_pay_cep(b, "2 minutes"), ["order_id", "tag", "create_ts", "pay_ts"]),
        "states": (lambda s: st.order_states_stream(s, "2 minutes", "60 seconds", chunk="5 minutes"),
                   lambda b: op.order_pay_states(b, "2 minutes"), ["order_id", "state", "create_ts", "pay_ts"])}[kind]
    df = spark.createDataFrame(hot_orders(7), ORDER_SCHEMA)
    parts = disordered(df, 60, 5, 7, {"order_id": -1, "event_type": "create"})
    out = replay(spark, parts, ORDER_SCHEMA, stream).where("order_id <> -1")
    assert _same(_epochs(out, cols), _epochs(batch(df), cols))


def test_no_chunk_holds_a_hot_key(spark):
    df = spark.createDataFrame(hot_logins(1, 3000), LOGIN_SCHEMA).withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    sizes = (halo_copies(df, 60_000_000, 3_000_000).groupBy("user_id", CHUNK)
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(OWN).cast("int")).alias("own")))
    assert sizes.where("user_id = 1").agg(F.sum("own")).first()[0] > 900
    assert sizes.agg(F.max("n")).first()[0] < 60
    # and copies are few
    assert sizes.agg(F.sum("n")).first()[0] < 1.1 * df.count()


def test_chunk_evaluations_of_empty_and_single_rows():
    one = np.array([5], np.int64), np.array([0], np.int64)
    for evaluate in (fail_sequences(2, 10, False), fail_sequences(3, 10, True), pays_after_creates(10),
                     order_states(10), reconciled(-3, 5)):
        for kind in (0, 1):
            for own in (True, False):
                out = evaluate(1, *one, np.array([kind], np.int64), np.array([own]))
                assert len(out) <= own


# ------------------------------------------------------- J1 / J2 by bucket

def tx_rows(seed, col, n=300):
    rng = random.Random(seed)
    rows, t = [], 0.0
    for q in range(n):
        t += rng.choice([0, .5, 1, 3])
        rows.append(("hot" if rng.random() < .4 else f"t{rng.randint(0, 40)}", at(t), q))
    return pd.DataFrame(rows, columns=["tx_id", col, "seq"])


def two_streams(spark, left, right, build, batches=4):
    """Replay two tables side by side, one file of each per micro-batch; the result of ``build``."""
    root = tempfile.mkdtemp(prefix="clickpulse-two-")
    srcs = [os.path.join(root, s) for s in ("left", "right")]
    for s in srcs:
        os.makedirs(s)
    frames = [left, right]
    streams = [spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(s)
               for f, s in zip(frames, srcs)]
    name = "two_" + os.path.basename(root).replace("-", "_")
    q = (build(*streams).writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(root, "ckpt")).start())
    try:
        pdfs = []
        for f in frames:
            ts = f.columns[1]
            pdf = f.toPandas()
            late = pdf[ts] + pd.to_timedelta(np.random.default_rng(3).uniform(0, 4, len(pdf)), unit="s")
            pdf = pdf.iloc[np.argsort(late.to_numpy(), kind="stable")]
            pdfs.append([*np.array_split(pdf, batches), pdf.head(1).assign(**{"tx_id": "far", ts: FAR})])
        for pair in zip(*pdfs):
            for f, s, part in zip(frames, srcs, pair):
                spark.createDataFrame(part, f.schema).coalesce(1).write.mode("append").parquet(s)
            q.processAllAvailable()
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name).where("tx_id <> 'far'")


def test_interval_join_by_bucket(spark):
    pays = spark.createDataFrame(tx_rows(1, "pay_ts"), "tx_id string, pay_ts timestamp_ntz, seq long").drop("seq")
    receipts = (spark.createDataFrame(tx_rows(2, "receipt_ts"), "tx_id string, receipt_ts timestamp_ntz, seq long")
                .withColumnRenamed("seq", "receipt_no"))
    out = two_streams(spark, pays, receipts,
                      lambda p, r: st.interval_join_stream(p, r, "tx_id", "pay_ts", "receipt_ts", left_delay="5 seconds",
                                                           right_delay="5 seconds", bucket="8 seconds"))
    want = op.interval_join(pays, receipts, ["tx_id"], "pay_ts", "receipt_ts")
    cols = ["tx_id", "pay_ts", "receipt_ts", "receipt_no"]
    assert _same(_epochs(out, cols), _epochs(want, cols)) and want.where("tx_id = 'hot'").count() > 100
    with pytest.raises(ValueError):
        st.interval_join_stream(pays, receipts, "tx_id", "pay_ts", "receipt_ts", how="full_outer", bucket="8 seconds")


def test_reconcile_by_chunk(spark):
    pays = spark.createDataFrame(tx_rows(1, "pay_ts"), "tx_id string, pay_ts timestamp_ntz, seq long").drop("seq")
    receipts = spark.createDataFrame(tx_rows(2, "receipt_ts"), "tx_id string, receipt_ts timestamp_ntz, seq long").drop("seq")
    out = two_streams(spark, pays, receipts,
                      lambda p, r: st.reconcile_stream(p, r, pay_delay="5 seconds", receipt_delay="5 seconds",
                                                       chunk="30 seconds"))
    want = op.reconcile(pays, receipts)
    cols = ["tx_id", "status", "pay_ts", "receipt_ts"]
    assert _same(_epochs(out, cols), _epochs(want, cols))
    assert {r.status for r in want.select("status").distinct().collect()} == {"matched", "paid_no_receipt", "receipt_no_pay"}


# ---------------------------------------------------------------- A3 / A4

def test_ring_windows_equal_batch_at_720_overlaps(spark):
    clicks = read_ad_clicks(spark, fixture("ad_clicks.csv")).drop("city")
    far = {"user_id": -1, "province": "zz"}
    parts = disordered(clicks, 30, 4, 1, far)
    out = replay(spark, parts, clicks.schema,
                 lambda s: st.sliding_counts_stream(s, "ts", ["province"], "1 hour", "5 seconds", "30 seconds"))
    want = op.province_counts(clicks, "1 hour", "5 seconds")
    cols = ["province", "window_start", "window_end", "cnt"]
    assert _same(_epochs(out.where("province <> 'zz'"), cols), _epochs(want, cols))


def test_ring_with_gaps_two_keys_and_one_state_row_per_key(spark):
    rng = random.Random(5)
    rows = sorted((rng.choice([rng.uniform(0, 300), rng.uniform(4000, 4100), rng.uniform(9000, 9900)]), q) for q in range(400))
    pdf = pd.DataFrame([("c" + str(q % 5), "b" + str(q % 2), at(int(t)), q) for t, q in rows],
                       columns=["channel", "behavior", "ts", "seq"])
    schema = "channel string, behavior string, ts timestamp_ntz, seq long"
    df = spark.createDataFrame(pdf, schema)
    parts = disordered(df, 20, 6, 2, {"channel": "far"})
    root = tempfile.mkdtemp(prefix="clickpulse-ring-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    build = st.sliding_counts_stream(stream, "ts", ["channel", "behavior"], "10 minutes", "7 seconds", "20 seconds")
    name = "ring_" + os.path.basename(root).replace("-", "_")
    q = (build.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(root, "ckpt")).start())
    most = 0
    try:
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
            for p in q.recentProgress:
                for o in p["stateOperators"]:
                    if "transformWithState" in o["operatorName"]:
                        most = max(most, o["numRowsTotal"])
    finally:
        q.stop()
    want = op.channel_behavior_counts(df, "10 minutes", "7 seconds")
    cols = ["channel", "behavior", "window_start", "window_end", "cnt"]
    assert _same(_epochs(spark.table(name).where("channel <> 'far'"), cols), _epochs(want, cols))
    # ten keys: a ring each, and the rows of one timer (by key and by time); 86 windows overlap
    assert 10 <= most <= 4 * 11


def test_ad_counts_stream_has_no_wide_window(spark):
    stream = spark.readStream.schema("user_id long, ad_id long, province string, ts timestamp_ntz, seq long").parquet(
        tempfile.mkdtemp(prefix="clickpulse-empty-"))
    plan = st.ad_counts_by_province_stream(stream)._jdf.queryExecution().analyzed().toString()
    wide = st.window_counts_stream(stream, "ts", ["province"], "1 hour", "5 seconds")
    # a window of many overlaps is an Expand of as many projections
    assert "Expand" not in plan and "Expand" in wide._jdf.queryExecution().analyzed().toString()


# -------------------------------------------------------------------- T3

def simulate(batches, size, slide, ooo, lateness):
    """Fired and corrected windows of micro-batches of (url, second): the definition, row by row."""
    out, counts, fired, newest, mark = [], {}, set(), None, None
    # Spark runs a micro-batch without rows whenever the watermark has moved
    for batch in [b for rows in batches for b in (rows, [])]:
        delay = ooo + lateness + size
        now = None if newest is None else max(0, int((newest - delay) * 1000) / 1000)
        now = mark if now is None or (mark is not None and mark > now) else now
        late_line, mark = mark, now
        fire = None if mark is None else mark + lateness + size
        touched = set()
        for url, t in batch:
            if late_line is not None and t <= late_line:
                continue
            k = int(t // slide)
            while k * slide + size > t:
                if fire is None or k * slide + size + lateness > fire:
                    counts[k, url] = counts.get((k, url), 0) + 1
                    touched.add((k, url))
                k -= 1
        if fire is not None:
            for (k, url), n in counts.items():
                if k * slide + size <= fire:
                    if (k, url) not in fired:
                        out.append((url, k * slide, n, "fired"))
                    elif (k, url) in touched:
                        out.append((url, k * slide, n, "corrected"))
            fired |= {key for key in counts if key[0] * slide + size <= fire}
        newest = max([t for _, t in batch] + ([] if newest is None else [newest]))
    return sorted(out)


def url_batches(seed):
    rng = random.Random(seed)
    batches, t = [], 100.0
    for b in range(7):
        rows = []
        for _ in range(rng.randint(5, 40)):
            t += rng.choice([0, .5, 1, 2])
            rows.append((rng.choice(["/hot", "/hot", "/a", "/b", f"/{rng.randint(0, 9)}"]),
                         max(0.0, t - rng.choice([0, 0, 0, 1, 5, 20, 60, 200]))))
        batches.append(rows)
    return batches


LOG_SCHEMA = "url string, method string, ts timestamp_ntz, seq long"


def log_part(batch):
    return pd.DataFrame([(u, "GET", at(t), 0) for u, t in batch], columns=["url", "method", "ts", "seq"])


@pytest.mark.parametrize("seed", [1])
def test_fired_windows_follow_the_definition(spark, seed):
    size, slide, ooo, lateness = 60, 5, 2, 30
    shift = (EPOCH - datetime.datetime(1970, 1, 1)).total_seconds()
    batches = url_batches(seed) + [[("/far", 5000.0)], [("/far", 5000.5)]]
    out = replay(spark, [log_part(b) for b in batches], LOG_SCHEMA,
                 lambda s: st.fired_counts_stream(s, ["url"], f"{size} seconds", f"{slide} seconds", f"{ooo} seconds",
                                                  f"{lateness} seconds"))
    assert shift % slide == 0
    got = sorted((r.url, int(r.us / 1e6 - shift), r.cnt, r.kind)
                 for r in out.select("url", F.unix_micros("window_start").alias("us"), "cnt", "kind").collect()
                 if r.url != "/far")
    want = [w for w in simulate([[(u, t + shift) for u, t in b] for b in batches], size, slide, ooo, lateness)]
    want = sorted((u, int(w - shift), n, kind) for u, w, n, kind in want if u != "/far")
    assert got == want
    assert {k for *_, k in got} == {"fired", "corrected"}


def test_fired_windows_in_order_equal_batch(spark):
    rng = random.Random(3)
    rows = sorted((rng.uniform(0, 900), rng.choice("abc")) for _ in range(300))
    pdf = pd.DataFrame([("/" + u, "GET", at(t), i) for i, (t, u) in enumerate(rows)], columns=["url", "method", "ts", "seq"])
    parts = [*np.array_split(pdf, 4), log_part([("/far", 90_000.0)]), log_part([("/far", 90_001.0)])]
    out = replay(spark, parts, LOG_SCHEMA, lambda s: st.fired_counts_stream(s, ["url"], "10 minutes", "5 seconds"))
    want = op.url_counts(spark.createDataFrame(pdf, LOG_SCHEMA), "10 minutes", "5 seconds")
    cols = ["url", "window_start", "window_end", "cnt"]
    # no row is late: every window is fired once, with all its rows
    assert _same(_epochs(out.where("kind = 'fired' AND url <> '/far'"), cols), _epochs(want, cols))


# -------------------------------------------------------------------- R2 / R4

def test_rankings_follow_corrections(spark):
    size, slide, ooo, lateness = 60, 5, 2, 30
    batches = url_batches(8) + [[("/far", 5000.0)], [("/far", 5000.5)]]
    parts = [log_part(b) for b in batches]
    out = replay(spark, parts, LOG_SCHEMA,
                 lambda s: st.hot_urls_stream(s, 3, f"{size} seconds", f"{slide} seconds", f"{ooo} seconds",
                                              f"{lateness} seconds", salts=4))
    shift = (EPOCH - datetime.datetime(1970, 1, 1)).total_seconds()
    final = {}
    for u, w, n, _ in simulate([[(u, t + shift) for u, t in b] for b in batches], size, slide, ooo, lateness):
        final.setdefault(w, {})
        final[w][u] = max(n, final[w].get(u, 0))
    want = sorted((w, rank, u, n) for w, urls in final.items() if "/far" not in urls
                  for rank, (u, n) in enumerate(sorted(urls.items(), key=lambda e: (-e[1], e[0]))[:3], 1))
    got = sorted((r.us / 1e6, r.rank, r.url, r.cnt) for r in st.latest_ranking(out)
                 .select(F.unix_micros("window_start").alias("us"), "rank", "url", "cnt").collect() if r.url != "/far")
    assert got == want and len(got) > 50


# ------------------------------------------------------------------ A8 / A7 / A9

def run_sink(spark, parts, schema, build, sink):
    root = tempfile.mkdtemp(prefix="clickpulse-run-")
    src, out = os.path.join(root, "src"), os.path.join(root, "out")
    os.makedirs(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (build(stream).writeStream.outputMode("append").foreachBatch(sink(out))
         .option("checkpointLocation", os.path.join(root, "ckpt")).start())
    try:
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
        q.processAllAvailable()
    finally:
        q.stop()
    return out


def test_running_uv_stream_equals_batch(spark):
    views = td.user_behavior(spark, SF_SMALL, pv_only=True).select("user_id", "behavior", "ts", "seq")
    rng = np.random.default_rng(1)
    pdf = views.toPandas()
    # three hours of traffic, one visitor a third of it
    pdf["ts"] = [at(s) for s in np.sort(rng.uniform(0, 3 * 3600, len(pdf))).round(1)]
    pdf.loc[rng.random(len(pdf)) < .34, "user_id"] = 7
    df = spark.createDataFrame(pdf, views.schema)
    parts = disordered(df, 600, 5, 2, {"user_id": -1, "seq": -1})
    out = run_sink(spark, parts, views.schema, lambda s: st.first_seen_stream(s, delay="10 minutes", buckets=4),
                   lambda path: st.running_sink(path))
    got = st.read_running(spark, out).where("seq <> -1")
    cols = ["seq", "ts", "window_start", "window_end", "uv"]
    assert _same(_epochs(got, cols), _epochs(op.uv_running(df), cols)) and got.count() == len(pdf)


def test_running_sink_repeats_an_epoch_once(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="clickpulse-epoch-"), "out")
    sink = st.running_sink(out)
    rows = [spark.createDataFrame([(0, u, s, f)], "window_us long, us long, seq long, first long")
            for u, s, f in [(1, 1, 1), (2, 2, 0), (3, 3, 1)]]
    for epoch in (0, 1, 1, 2, 2):
        sink(rows[epoch], epoch)
    assert sorted((r.seq, r.uv) for r in st.read_running(spark, out).collect()) == [(1, 1), (2, 1), (3, 2)]


@pytest.mark.parametrize("kind", ["bitmap", "sketch"])
def test_streamed_stores_equal_batch_stores(spark, kind):
    views = td.user_behavior(spark, SF_SMALL, pv_only=True).select("user_id", "behavior", "ts", "seq")
    build = {"bitmap": st.bitmap_store_stream, "sketch": st.sketch_store_stream}[kind]
    parts = disordered(views, 3000, 3, 4, {"user_id": -1})
    out = replay(spark, parts, views.schema, lambda s: build(s, "1 hour", delay="1 hour"))
    out = out.where(F.col("window_start") < F.lit("2090-01-01").cast("timestamp"))
    if kind == "bitmap":
        merged, batch = op.uv_from_bitmaps(out, "1 day"), op.uv_bitmap(views, "1 day")
    else:
        merged = op.uv_from_sketches(out, "2 hours", "1 hour")
        batch = op.uv_from_sketches(op.sketch_store(views, "1 hour"), "2 hours", "1 hour")
    cols = ["window_start", "window_end", "uv"]
    assert _same(_epochs(merged, cols), _epochs(batch, cols)) and merged.count() > 10
