"""Operators on the fixture files against row-by-row brute force (event-time order).

The fixtures are invented rows (``scripts/make_fixtures.py``) that hit the
bounds of every pattern; the brute force reads the files itself.
"""

import calendar
import csv
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.sources import read_ad_clicks, read_logins, read_orders, read_receipts
from tests.conftest import fixture


def lines(name):
    """Rows in event-time order, ties in file order; the last field as a number."""
    with open(fixture(name)) as f:
        rows = [(*r[:-1], int(r[-1])) for r in csv.reader(f)]
    return sorted(rows, key=lambda r: r[-1])


def secs(t):
    return calendar.timegm(t.timetuple())


def by_key(rows):
    out = defaultdict(list)
    for r in rows:
        out[int(r[0])].append(r[1:])
    return out


def brute_pairs(n, within, consecutive):
    out = []
    for user, rows in by_key(lines("logins.csv")).items():
        seq = rows if consecutive else [r for r in rows if r[1] == "fail"]
        for i in range(len(seq) - n + 1):
            run = seq[i:i + n]
            if all(r[1] == "fail" for r in run) and run[-1][-1] - run[0][-1] < within:
                out.append((user, run[0][-1], run[-1][-1]))
    return sorted(out)


def brute_bursts(within):
    out = []
    for user, rows in by_key(lines("logins.csv")).items():
        group = None
        for _, kind, t in rows:
            if group and t > group[0] + within:
                out.append((user, *group))
                group = None
            if kind == "fail":
                group = (group[0], t, group[2] + 1) if group else (t, t, 1)
            else:
                group = None
        if group:
            out.append((user, *group))
    return sorted(g for g in out if g[3] >= 2)


def brute_cep(within):
    out = []
    for order, rows in by_key(lines("order_events.csv")).items():
        for i, (kind, _, t) in enumerate(rows):
            if kind == "create":
                pay = next((r[-1] for r in rows[i + 1:] if r[0] == "pay"), None)
                ok = pay is not None and pay - t < within
                out.append((order, "matched" if ok else "timeout", t, pay if ok else None))
    return sorted(out, key=str)


def brute_states(timeout):
    out = []
    for order, rows in by_key(lines("order_events.csv")).items():
        opened = None
        for kind, _, t in rows:
            if opened is not None and t > opened + timeout:
                out.append((order, "not_paid"))
                opened = None
            if kind == "create":
                opened = t
            elif opened is not None:
                out.append((order, "paid"))
                opened = None
            else:
                out.append((order, "pay_without_open_order"))
        if opened is not None:
            out.append((order, "not_paid"))
    return sorted(out)


def brute_reconcile(lo, hi):
    pays = [(r[2], r[3]) for r in lines("order_events.csv") if r[1] == "pay"]
    recs = [(r[0], r[2]) for r in lines("receipts.csv")]
    pairs = [(p[0], r[1] - p[1]) for p in pays for r in recs if p[0] == r[0] and lo <= r[1] - p[1] <= hi]
    met = {t for t, _ in pairs}
    return pairs, sum(p[0] not in met for p in pays), sum(r[0] not in met for r in recs)


def pairs_of(df):
    return sorted((r.user_id, secs(r.first_ts), secs(r.last_ts)) for r in df.collect())


def test_login_consecutive_strict(spark):
    lg = read_logins(spark, fixture("logins.csv"))
    assert lg.count() == len(lines("logins.csv"))
    want = brute_pairs(2, 2, True)
    assert pairs_of(op.consecutive_fails(lg, "2 seconds")) == want and len(want) > 5


def test_login_times_relaxed(spark):
    lg = read_logins(spark, fixture("logins.csv"))
    for n, within, consecutive in [(2, 2, False), (2, 3, False), (2, 3, True), (3, 4, False)]:
        want = brute_pairs(n, within, consecutive)
        got = pairs_of(op.fails_times_n(lg, n, f"{within} seconds", consecutive=consecutive))
        assert got == want and want, (n, within, consecutive)
    assert brute_pairs(2, 2, False) != brute_pairs(2, 3, False) != brute_pairs(2, 3, True)


def test_login_fail_burst(spark):
    rows = op.login_fail_bursts(read_logins(spark, fixture("logins.csv")), "2 seconds").collect()
    want = brute_bursts(2)
    assert sorted((r.user_id, secs(r.first_ts), secs(r.last_ts), r.n_fails) for r in rows) == want
    # a chain of seven fails makes two groups of three; a success cuts user 10's first fail off
    assert sum(w[0] == 12 for w in want) == 2 and sum(w[0] == 10 for w in want) == 1


def test_order_pay_cep(spark):
    got = op.order_pay_cep(read_orders(spark, fixture("order_events.csv")), "15 minutes").collect()
    want = brute_cep(900)
    assert sorted(((r.order_id, r.tag, secs(r.create_ts), r.pay_ts and secs(r.pay_ts)) for r in got), key=str) == want
    tags = {o: t for o, t, _, _ in want}
    assert (tags[900], tags[901], tags[902], tags[950]) == ("matched", "timeout", "timeout", "timeout")


def test_order_pay_states(spark):
    got = op.order_pay_states(read_orders(spark, fixture("order_events.csv")), "15 minutes").collect()
    want = brute_states(900)
    assert sorted((r.order_id, r.state) for r in got) == want
    assert (901, "paid") in want and (902, "not_paid") in want and (951, "pay_without_open_order") in want


def pays_receipts(spark):
    pays = (read_orders(spark, fixture("order_events.csv")).where("event_type = 'pay'")
            .select("tx_id", F.col("ts").alias("pay_ts")))
    rec = (read_receipts(spark, fixture("receipts.csv"))
           .select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts")))
    return pays, rec


def test_interval_join(spark):
    pays, rec = pays_receipts(spark)
    rows = op.interval_join(pays, rec, ["tx_id"], "pay_ts", "receipt_ts", "-3 seconds", "5 seconds").collect()
    want, _, _ = brute_reconcile(-3, 5)
    assert sorted((r.tx_id, int((r.receipt_ts - r.pay_ts).total_seconds())) for r in rows) == sorted(want)
    assert {d for _, d in want} >= {-3, 0, 3, 5}


def test_reconcile(spark):
    pays, rec = pays_receipts(spark)
    r = op.reconcile(pays, rec.drop("pay_channel"), "tx_id", "pay_ts", "receipt_ts", "-3 seconds", "5 seconds")
    pairs, lone_pays, lone_receipts = brute_reconcile(-3, 5)
    assert {x.status: x["count"] for x in r.groupBy("status").count().collect()} == {
        "matched": len(pairs), "paid_no_receipt": lone_pays, "receipt_no_pay": lone_receipts}


def test_blacklist_and_province_counts(spark):
    clicks = read_ad_clicks(spark, fixture("ad_clicks.csv"))
    seen, passed, warned = Counter(), [], []
    for user, ad, province, _, t in lines("ad_clicks.csv"):
        day = (int(user), int(ad), (t + 8 * 3600) // 86400)
        seen[day] += 1
        if seen[day] < 100:
            passed.append((province, t))
        elif seen[day] == 100:
            warned.append(day[:2])
    got = op.clicks_passed(clicks, 100)
    assert sorted((r.province, secs(r.ts)) for r in got.collect()) == sorted(passed)
    assert [(w.user_id, w.ad_id) for w in op.blacklist_warnings(clicks, 100).collect()] == warned == [(77, 3)]
    windows = Counter()
    for province, t in passed:
        for k in range(720):
            windows[province, (t // 5 - k) * 5] += 1
    counts = op.ad_counts_by_province(clicks, 100, "1 hour", "5 seconds")
    assert {(r.province, secs(r.window_start)): r.cnt for r in counts.collect()} == windows
