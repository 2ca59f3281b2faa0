"""Edge rows: exact bounds, equal timestamps, day change, empty input."""

import datetime as dt

from pyspark.sql import functions as F

from clickpulse import operators as op

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def _orders(spark, rows):
    return spark.createDataFrame(
        [(o, e, None, _at(s), q) for q, (o, e, s) in enumerate(rows)],
        "order_id long, event_type string, tx_id string, ts timestamp_ntz, seq long")


def _logins(spark, rows):
    return spark.createDataFrame([(u, e, _at(s), q) for q, (u, e, s) in enumerate(rows)],
                                 "user_id long, event_type string, ts timestamp_ntz, seq long")


def test_order_state_bound_is_inclusive(spark):
    o = _orders(spark, [(1, "create", 0), (1, "pay", 900), (2, "create", 0), (2, "pay", 901)])
    got = sorted((r.order_id, r.state) for r in op.order_pay_states(o, "15 minutes").collect())
    assert got == [(1, "paid"), (2, "not_paid"), (2, "pay_without_open_order")]


def test_order_states_recreate_and_double_pay(spark):
    o = _orders(spark, [(1, "create", 0), (1, "create", 100), (1, "pay", 950), (1, "pay", 960),
                        (2, "pay", 5)])
    got = sorted((r.order_id, r.state, r.create_ts) for r in
                 op.order_pay_states(o, "15 minutes").collect())
    # the later create re-anchors the deadline; the second pay finds no open order
    assert got == [(1, "paid", _at(100)), (1, "pay_without_open_order", None),
                   (2, "pay_without_open_order", None)]


def test_cep_within_is_strict(spark):
    o = _orders(spark, [(1, "create", 0), (1, "pay", 900), (2, "create", 0), (2, "pay", 899)])
    got = sorted((r.order_id, r.tag) for r in op.order_pay_cep(o, "15 minutes").collect())
    assert got == [(1, "timeout"), (2, "matched")]


def test_cep_two_creates_share_first_pay(spark):
    o = _orders(spark, [(1, "create", 0), (1, "create", 10), (1, "pay", 20)])
    got = sorted((r.create_ts, r.tag) for r in op.order_pay_cep(o, "15 minutes").collect())
    assert got == [(_at(0), "matched"), (_at(10), "matched")]


def test_interval_join_bounds_inclusive(spark):
    pays = spark.createDataFrame([("a", _at(0))], "tx_id string, pay_ts timestamp_ntz")
    rec = spark.createDataFrame(
        [("a", _at(-3)), ("a", _at(5)), ("a", _at(-3) - dt.timedelta(microseconds=1)),
         ("a", _at(5) + dt.timedelta(microseconds=1)), ("b", _at(0))],
        "tx_id string, receipt_ts timestamp_ntz")
    got = sorted(r.receipt_ts for r in
                 op.interval_join(pays, rec, ["tx_id"], "pay_ts", "receipt_ts").collect())
    assert got == [_at(-3), _at(5)]
    rc = {r.status: r["count"] for r in
          op.reconcile(pays, rec).groupBy("status").count().collect()}
    assert rc == {"matched": 2, "receipt_no_pay": 3}


def test_blacklist_day_changes_at_1600_utc(spark):
    d = dt.datetime(2024, 1, 1, 15, 59, 59)
    clicks = spark.createDataFrame(
        [(1, 7, "p", d, 0), (1, 7, "p", d + dt.timedelta(seconds=1), 1),
         (1, 7, "p", d + dt.timedelta(seconds=2), 2)],
        "user_id long, ad_id long, province string, ts timestamp_ntz, seq long")
    r = op.rank_clicks(clicks, 2).orderBy("seq").collect()
    assert [(str(x.day), x.click_no, x.tag) for x in r] == [
        ("2024-01-01", 1, "passed"), ("2024-01-02", 1, "passed"), ("2024-01-02", 2, "blacklist")]


def test_blacklist_max_one_warns_at_second_click(spark):
    clicks = spark.createDataFrame([(1, 7, "p", _at(i), i) for i in range(3)],
                                   "user_id long, ad_id long, province string, ts timestamp_ntz, seq long")
    assert op.clicks_passed(clicks, 1).count() == 1
    assert op.blacklist_warnings(clicks, 1).first().warn_ts == _at(1)


def test_burst_deadline_edges(spark):
    # fail at the deadline joins the group; a success at the deadline kills it
    joins = _logins(spark, [(1, "fail", 0), (1, "fail", 2), (1, "success", 3)])
    kills = _logins(spark, [(2, "fail", 0), (2, "fail", 1), (2, "success", 2)])
    assert [(r.user_id, r.n_fails) for r in op.login_fail_bursts(joins, "2 seconds").collect()] \
        == [(1, 2)]
    assert op.login_fail_bursts(kills, "2 seconds").count() == 0


def test_burst_long_chain(spark):
    # fails every second for 40 s: greedy groups [0,2], [3,5], ... -> 10 groups of 3, 1 of 1
    lg = _logins(spark, [(1, "fail", s) for s in range(40)] + [(1, "success", 100)])
    got = sorted((r.first_ts, r.n_fails) for r in op.login_fail_bursts(lg, "2 seconds").collect())
    assert [n for _, n in got] == [3] * 13
    assert [t for t, _ in got] == [_at(3 * i) for i in range(13)]


def test_equal_timestamps_break_by_seq(spark):
    lg = _logins(spark, [(1, "fail", 0), (1, "success", 0), (1, "fail", 0)])
    # in seq order: fail, success, fail -> no two consecutive fails
    assert op.consecutive_fails(lg, "2 seconds").count() == 0
    assert op.fails_times_n(lg, 2, "2 seconds").count() == 1


def test_empty_inputs(spark):
    assert op.login_fail_bursts(_logins(spark, []), "2 seconds").count() == 0
    assert op.order_pay_states(_orders(spark, []), "15 minutes").count() == 0
    empty = spark.createDataFrame([], "item_id long, behavior string, ts timestamp_ntz")
    assert op.item_counts(empty, "1 hour", "5 seconds").count() == 0
    assert op.hot_items(empty, 5, "1 hour", "5 minutes").count() == 0


def test_null_timestamps_are_ignored(spark):
    df = spark.createDataFrame([(1, "pv", _at(0)), (2, "pv", None)],
                               "item_id long, behavior string, ts timestamp_ntz")
    for plan in ["pane", "direct"]:
        c = op.item_counts(df, "1 hour", "5 minutes", plan=plan)
        assert c.agg(F.sum("cnt")).first()[0] == 12


def test_inclusive_switch(spark):
    o = _orders(spark, [(1, "create", 0), (1, "pay", 900)])
    assert op.order_pay_cep(o, "15 minutes").first().tag == "timeout"
    assert op.order_pay_cep(o, "15 minutes", inclusive=True).first().tag == "matched"
    assert sorted(r.state for r in op.order_pay_states(o, "15 minutes", inclusive=False).collect()) \
        == ["not_paid", "pay_without_open_order"]
    lg = _logins(spark, [(1, "fail", 0), (1, "fail", 2)])
    assert op.consecutive_fails(lg, "2 seconds").count() == 0
    assert op.consecutive_fails(lg, "2 seconds", inclusive=True).count() == 1
    assert op.fails_times_n(lg, 2, "2 seconds", inclusive=True).count() == 1
