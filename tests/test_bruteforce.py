"""Random event sequences: Spark operators equal a plain sequential simulation."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from clickpulse import operators as op

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

events = st.lists(st.tuples(st.integers(1, 2), st.booleans(), st.integers(0, 40)),
                  min_size=0, max_size=40)


def _sorted(rows):
    # (key, flag, second, seq) in processing order: (ts, seq)
    return sorted(((k, f, s, i) for i, (k, f, s) in enumerate(rows)), key=lambda r: (r[2], r[3]))


def burst_sim(rows, w):
    out = []
    for key in {r[0] for r in rows}:
        g = None
        for _, fail, s, _ in [r for r in _sorted(rows) if r[0] == key]:
            if g and s > g[0] + w:
                if g[2] >= 2:
                    out.append((key, g[0], g[1], g[2]))
                g = None
            if fail:
                g = (s, s, 1) if g is None else (g[0], s, g[2] + 1)
            else:
                g = None
        if g and g[2] >= 2:
            out.append((key, g[0], g[1], g[2]))
    return sorted(out)


@SETTINGS
@given(events, st.integers(1, 6))
def test_login_bursts_match_simulation(spark, rows, w):
    df = spark.createDataFrame(
        [(k, "fail" if f else "success", T0 + dt.timedelta(seconds=s), i)
         for i, (k, f, s) in enumerate(rows)],
        "user_id long, event_type string, ts timestamp_ntz, seq long")
    got = sorted((r.user_id, int((r.first_ts - T0).total_seconds()),
                  int((r.last_ts - T0).total_seconds()), r.n_fails)
                 for r in op.login_fail_bursts(df, f"{w} seconds", chunk="3 seconds").collect())
    assert got == burst_sim(rows, w)


def states_sim(rows, t):
    out = []
    for key in {r[0] for r in rows}:
        c = None
        for _, pay, s, _ in [r for r in _sorted(rows) if r[0] == key]:
            if c is not None and s > c + t:
                out.append((key, "not_paid", c, None))
                c = None
            if not pay:
                c = s
            elif c is not None:
                out.append((key, "paid", c, s))
                c = None
            else:
                out.append((key, "pay_without_open_order", None, s))
        if c is not None:
            out.append((key, "not_paid", c, None))
    return sorted(out, key=str)


@SETTINGS
@given(events, st.integers(1, 8))
def test_order_states_match_simulation(spark, rows, t):
    df = spark.createDataFrame(
        [(k, "pay" if f else "create", T0 + dt.timedelta(seconds=s), i)
         for i, (k, f, s) in enumerate(rows)],
        "order_id long, event_type string, ts timestamp_ntz, seq long")

    def sec(x):
        return None if x is None else int((x - T0).total_seconds())
    got = sorted(((r.order_id, r.state, sec(r.create_ts), sec(r.pay_ts))
                  for r in op.order_pay_states(df, f"{t} seconds", chunk="2 seconds").collect()),
                 key=str)
    assert got == states_sim(rows, t)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 30)), max_size=25),
       st.lists(st.tuples(st.integers(1, 3), st.integers(0, 30)), max_size=25),
       st.integers(-6, 0), st.integers(0, 6))
def test_interval_join_matches_nested_loop(spark, left, right, lo, hi):
    lf = spark.createDataFrame([(k, i, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(left)],
                               "k long, li long, lts timestamp_ntz")
    rf = spark.createDataFrame([(k, i, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(right)],
                               "k long, ri long, rts timestamp_ntz")
    got = sorted((r.li, r.ri) for r in
                 op.interval_join(lf, rf, ["k"], "lts", "rts", f"{lo} seconds", f"{hi} seconds",
                                  bucket="2 seconds").collect())
    exp = sorted((i, j) for i, (k1, s1) in enumerate(left) for j, (k2, s2) in enumerate(right)
                 if k1 == k2 and s1 + lo <= s2 <= s1 + hi)
    assert got == exp
