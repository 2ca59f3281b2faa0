"""Pattern streams on input that arrives out of order inside the watermark delay.

Rows are delayed at random by less than the delay, replayed in at least three
micro-batches, and must give the batch operator's rows.
"""

import datetime
import os
import tempfile

import numpy as np
import pandas as pd
import pytest

from clickpulse import operators as op
from clickpulse import streaming as st
from clickpulse.sources import read_logins, read_orders
from clickpulse.sources import testdata as td
from tests.conftest import SF_SMALL, fixture
from tests.test_streaming import FAR, _epochs, _same

EPOCH = datetime.datetime(2024, 1, 1)


def replay(spark, parts, schema, build):
    root = tempfile.mkdtemp(prefix="clickpulse-order-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    name = "out_" + os.path.basename(root).replace("-", "_")
    q = (build(stream).writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", os.path.join(root, "ckpt")).start())
    try:
        for part in parts:
            spark.createDataFrame(part, schema=schema).coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(name)


def disordered(df, seconds, batches, seed, sentinel):
    """Rows in order of their time plus a random delay below ``seconds``, and a far-future row."""
    pdf = df.toPandas()
    late = pdf["ts"] + pd.to_timedelta(np.random.default_rng(seed).uniform(0, seconds, len(pdf)), unit="s")
    pdf = pdf.iloc[np.argsort(late.to_numpy(), kind="stable")]
    assert not pdf["ts"].is_monotonic_increasing
    return [*np.array_split(pdf, batches), pdf.head(1).assign(ts=FAR, **sentinel)]


LOGIN_STREAMS = {
    "burst": (lambda s, w, d: st.login_burst_stream(s, w, delay=d), lambda b, w: op.login_fail_bursts(b, w),
              ["user_id", "first_ts", "last_ts", "n_fails"]),
    "next": (lambda s, w, d: st.fail_sequence_stream(s, 2, w, True, delay=d), lambda b, w: op.consecutive_fails(b, w),
             ["user_id", "first_seq", "first_ts", "last_seq", "last_ts"]),
    "times 2": (lambda s, w, d: st.fail_sequence_stream(s, 2, w, delay=d), lambda b, w: op.fails_times_n(b, 2, w),
                ["user_id", "first_seq", "first_ts", "last_seq", "last_ts"]),
    "times 3": (lambda s, w, d: st.fail_sequence_stream(s, 3, w, delay=d), lambda b, w: op.fails_times_n(b, 3, w),
                ["user_id", "first_seq", "first_ts", "last_seq", "last_ts"]),
}
ORDER_STREAMS = {
    "cep": (lambda s, w, d: st.order_pay_cep_stream(s, w, delay=d), lambda b, w: op.order_pay_cep(b, w),
            ["order_id", "tag", "create_ts", "pay_ts"]),
    "states": (lambda s, w, d: st.order_states_stream(s, w, delay=d), lambda b, w: op.order_pay_states(b, w),
               ["order_id", "state", "create_ts", "pay_ts"]),
}


@pytest.mark.parametrize("kind", LOGIN_STREAMS)
def test_login_streams(spark, kind):
    stream, batch, cols = LOGIN_STREAMS[kind]
    lg = read_logins(spark, fixture("logins.csv"))
    parts = disordered(lg, 5, 5, 1, {"user_id": -1, "event_type": "success"})
    out = replay(spark, parts, lg.schema, lambda s: stream(s, "3 seconds", "5 seconds"))
    want = batch(lg, "3 seconds")
    assert _same(_epochs(out, cols), _epochs(want, cols)) and want.count() > 0


@pytest.mark.parametrize("kind", ORDER_STREAMS)
def test_order_streams(spark, kind):
    stream, batch, cols = ORDER_STREAMS[kind]
    orders = read_orders(spark, fixture("order_events.csv"))
    parts = disordered(orders, 400, 6, 2, {"order_id": -1, "event_type": "create"})
    out = replay(spark, parts, orders.schema, lambda s: stream(s, "15 minutes", "400 seconds"))
    assert _same(_epochs(out.where("order_id <> -1"), cols), _epochs(batch(orders, "15 minutes"), cols))


def test_login_burst_on_driver_events(spark):
    lg = td.logins(spark, SF_SMALL)
    stream, batch, cols = LOGIN_STREAMS["burst"]
    parts = disordered(lg, 86_400, 4, 3, {"user_id": -1, "event_type": "success"})
    out = replay(spark, parts, lg.schema, lambda s: stream(s, "12 hours", "1 day"))
    want = batch(lg, "12 hours")
    assert _same(_epochs(out, cols), _epochs(want, cols)) and want.count() > 0


def login_rows(*rows):
    return pd.DataFrame([(1, "ip", k, EPOCH + datetime.timedelta(seconds=t), q) for k, t, q in rows],
                        columns=["user_id", "ip", "event_type", "ts", "seq"])


def far_row(df):
    return df.head(1).assign(ts=FAR, **{df.columns[0]: -1})


LOGIN_SCHEMA = "user_id long, ip string, event_type string, ts timestamp_ntz, seq long"
ORDER_SCHEMA = "order_id long, event_type string, ts timestamp_ntz, seq long"


def test_earlier_fail_in_a_later_batch_makes_no_backward_match(spark):
    a, b = login_rows(("fail", 100, 1)), login_rows(("fail", 97, 2))
    for build in (lambda s: st.fail_sequence_stream(s, 2, "2 seconds"),
                  lambda s: st.login_burst_stream(s, "2 seconds")):
        assert replay(spark, [a, b, far_row(a)], LOGIN_SCHEMA, build).count() == 0
    near = login_rows(("fail", 99, 2))
    out = replay(spark, [a, near, far_row(a)], LOGIN_SCHEMA, lambda s: st.fail_sequence_stream(s, 2, "2 seconds"))
    assert [(r.first_seq, r.last_seq) for r in out.collect()] == [(2, 1)]


def test_pay_that_arrives_before_its_create_is_matched(spark):
    def row(kind, t):
        return pd.DataFrame([(5, kind, EPOCH + datetime.timedelta(seconds=t), t)],
                            columns=["order_id", "event_type", "ts", "seq"])
    parts = [row("pay", 105), row("create", 102), far_row(row("create", 0))]
    out = replay(spark, parts, ORDER_SCHEMA, lambda s: st.order_pay_cep_stream(s, "15 minutes", delay="5 seconds"))
    assert [(r.order_id, r.tag) for r in out.where("order_id = 5").collect()] == [(5, "matched")]
    out = replay(spark, parts, ORDER_SCHEMA, lambda s: st.order_states_stream(s, "15 minutes", delay="5 seconds"))
    assert [(r.order_id, r.state) for r in out.where("order_id = 5").collect()] == [(5, "paid")]


def test_late_click_of_the_day_before_resets_no_count(spark):
    schema = "user_id long, ad_id long, province string, ts timestamp_ntz, seq long"
    noon = datetime.datetime(2024, 1, 2, 4)      # local noon in UTC+8

    def rows(*hours):
        return pd.DataFrame([(1, 2, "p", noon + datetime.timedelta(hours=h), k) for k, h in enumerate(hours)],
                            columns=["user_id", "ad_id", "province", "ts", "seq"])
    out = replay(spark, [rows(0, 1), rows(-13), rows(2), rows(3)], schema,
                 lambda s: st.blacklist_stream(s, 3, delay="2 days")).collect()
    assert sorted((r.day_index, r.click_no, r.tag) for r in out) == [
        (19723, 1, "passed"), (19724, 1, "passed"), (19724, 2, "passed"), (19724, 3, "blacklist")]
