"""Registered queries over the driver's tables, with DuckDB oracles.

Each query maps the tables to a reference record role (``sources.testdata``)
and runs one operator over the whole tables. ``events`` is sparse, so time
bounds that are seconds in the reference are scaled to hours or days here;
the operators keep the reference values as their defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.sources import testdata as td

H = 3_600_000_000          # one hour in microseconds

# Parameters of the registered queries. Windows keep the reference's sizes;
# pattern and join bounds are scaled from seconds to hours or days because
# one user's events are hours apart in ``events``. The URL ranking keeps two
# rows per window: no 10-minute window of ``events`` has more than five URLs.
# Order queries have no pay before its create (the mapping pairs an order with
# its first ship date on or after the order date); tests cover that branch.
ITEM_WINDOW = ("1 hour", "5 minutes")          # reference value
URL_WINDOW = ("10 minutes", "5 seconds")       # reference value
CHANNEL_WINDOW = ("1 hour", "5 seconds")       # reference value (720 overlaps)
URL_TOP = 2                                    # reference: 5
AD_WINDOW = ("1 hour", "5 seconds")            # reference value (720 overlaps)
AD_MAX_CLICKS = 2                              # reference: 100
AD_MAX_CLICKS_WIDE = 3                         # beside it, so that counts above one pass
BITMAP_CAP = 1 << 30                           # reference value
HLL_LG_K = 12                                  # sketch registers: 2^12, error 1.04 / 64
HLL_BOUND = 0.065                              # four standard errors
SKETCH_PANE, SKETCH_WINDOW = "15 minutes", ("1 hour", "15 minutes")
LOGIN_STRICT = "6 hours"                       # reference: 2 seconds
LOGIN_RELAXED = "2 hours"                      # reference: 2 seconds
LOGIN_RELAXED_WIDE = "3 hours"                 # reference: 3 seconds
LOGIN_BURST = "12 hours"                       # reference: 2 seconds
ORDER_WITHIN = "150 days"                      # reference: 15 minutes
RECEIPT_BOUNDS = ("-300 days", "500 days")     # reference: -3 s / +5 s
EVENT_JOIN_BOUNDS = ("-3 hours", "5 hours")    # reference shape in hours


def _bigint(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("bigint"))
    return df


# ---------------------------------------------------------------- Spark side

def q_sliding_item_counts(spark, d):
    return op.item_counts(td.user_behavior(spark, d, pv_only=True), *ITEM_WINDOW)


def q_hot_items_topn(spark, d):
    return _bigint(op.hot_items(td.user_behavior(spark, d, pv_only=True), 5, *ITEM_WINDOW), "rank")


def q_hot_items_sql(spark, d):
    return _bigint(op.hot_items_sql(spark, td.user_behavior(spark, d, pv_only=True), 5, *ITEM_WINDOW), "rank")


def q_sliding_url_counts(spark, d):
    return op.url_counts(td.access_log(spark, d), *URL_WINDOW)


def q_hot_urls_topn(spark, d):
    return _bigint(op.hot_urls(td.access_log(spark, d), URL_TOP, *URL_WINDOW), "rank")


def q_channel_behavior_counts(spark, d):
    return op.channel_behavior_counts(td.market_events(spark, d), *CHANNEL_WINDOW)


def q_page_views_hourly(spark, d):
    return op.page_views(td.user_behavior(spark, d, pv_only=True), "1 hour")


def q_page_views_salted(spark, d):
    return op.page_views_salted(td.user_behavior(spark, d, pv_only=True), "1 hour", buckets=8)


def q_uv_hourly_exact(spark, d):
    return op.uv_exact(td.user_behavior(spark, d), "1 hour")


def q_uv_hourly_bitmap(spark, d):
    return op.uv_bitmap(td.user_behavior(spark, d, pv_only=True), "1 hour", cap=BITMAP_CAP)


def q_uv_hourly_running(spark, d):
    return op.uv_running(td.user_behavior(spark, d, pv_only=True), "1 hour")


def q_uv_hourly_hll(spark, d):
    """The sketch's estimate held against the exact count: the count, and whether the error is in bounds."""
    views = td.user_behavior(spark, d, pv_only=True)
    est = op.uv_hll(views, "1 hour", lg_config_k=HLL_LG_K, out="estimate").drop("sketch", "window_end")
    both = op.uv_exact(views, "1 hour").join(est, "window_start")
    off = F.abs(F.col("estimate") - F.col("uv"))
    return both.select("window_start", "window_end", "uv",
                       (off <= F.greatest(F.lit(1.0), F.col("uv") * HLL_BOUND)).alias("within_bound"))


def q_uv_daily_bitmap_merged(spark, d):
    """Days merged from the bitmaps of their hours."""
    hours = op.bitmap_store(td.user_behavior(spark, d, pv_only=True), "1 hour", cap=BITMAP_CAP)
    return op.uv_from_bitmaps(hours, "1 day")


def q_uv_sliding_sketches(spark, d):
    """Sliding windows estimated from the panes' sketches, held against the exact count."""
    views = td.user_behavior(spark, d, pv_only=True)
    panes = op.sketch_store(views, SKETCH_PANE, lg_config_k=HLL_LG_K)
    est = op.uv_from_sketches(panes, *SKETCH_WINDOW, out="estimate").drop("window_end")
    users = views.select(F.window("ts", *SKETCH_WINDOW).alias("w"), "user_id")
    exact = users.groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")).agg(
        F.count_distinct("user_id").alias("uv"))
    off = F.abs(F.col("estimate") - F.col("uv"))
    return exact.join(est, "window_start").select(
        "window_start", "window_end", "uv", (off <= F.greatest(F.lit(1.0), F.col("uv") * HLL_BOUND)).alias("within_bound"))


def _passed(spark, d, most):
    # the limit comes before the geography: at most ``most`` rows of a user, ad and day meet the join
    return td.with_province(spark, d, op.clicks_passed(td.ad_clicks(spark, d), most))


def q_ad_clicks_passed(spark, d):
    return _passed(spark, d, AD_MAX_CLICKS)


def q_ad_clicks_passed_wide(spark, d):
    return _passed(spark, d, AD_MAX_CLICKS_WIDE)


def q_ad_blacklist_warnings(spark, d):
    w = op.blacklist_warnings(td.ad_clicks(spark, d), AD_MAX_CLICKS)
    known = td.with_province(spark, d, w).drop("province")
    # the day as ISO text: DATE converts to different pandas types on each side
    return known.withColumn("day", F.col("day").cast("string"))


def q_ad_counts_by_province(spark, d):
    return op.province_counts(_passed(spark, d, AD_MAX_CLICKS), *AD_WINDOW)


def q_login_fail_consecutive(spark, d):
    return op.consecutive_fails(td.logins(spark, d), LOGIN_STRICT)


def q_login_fail_times_n(spark, d):
    return _bigint(op.fails_times_n(td.logins(spark, d), 2, LOGIN_RELAXED), "n_fails")


def q_login_fail_times_n_wide(spark, d):
    return _bigint(op.fails_times_n(td.logins(spark, d), 2, LOGIN_RELAXED_WIDE), "n_fails")


def q_login_fail_burst(spark, d):
    return op.login_fail_bursts(td.logins(spark, d), LOGIN_BURST)


def q_order_pay_matched(spark, d):
    r = op.order_pay_cep(td.order_events(spark, d), ORDER_WITHIN)
    return r.where(F.col("tag") == "matched").drop("tag")


def q_order_pay_timeout(spark, d):
    r = op.order_pay_cep(td.order_events(spark, d), ORDER_WITHIN)
    return r.where(F.col("tag") == "timeout").drop("tag", "pay_ts")


def q_order_pay_states(spark, d):
    return op.order_pay_states(td.order_events(spark, d), ORDER_WITHIN)


def _pays_receipts(spark, d):
    p = td.pays(spark, d).withColumnRenamed("ts", "pay_ts")
    r = td.receipts(spark, d).withColumnRenamed("ts", "receipt_ts")
    return p, r


def q_order_receipt_interval_join(spark, d):
    p, r = _pays_receipts(spark, d)
    return op.interval_join(p, r, ["tx_id"], "pay_ts", "receipt_ts", *RECEIPT_BOUNDS)


def q_order_receipt_reconcile(spark, d):
    p, r = _pays_receipts(spark, d)
    return op.reconcile(p, r.drop("pay_channel"), "tx_id", "pay_ts", "receipt_ts", *RECEIPT_BOUNDS)


def q_interval_join_events(spark, d):
    ev = td.table(spark, d, "events")
    buys = ev.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    views = ev.where(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return op.interval_join(buys, views, ["user_id"], "purchase_ts", "view_ts", *EVENT_JOIN_BOUNDS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sliding_item_counts": q_sliding_item_counts,
    "hot_items_topn": q_hot_items_topn,
    "hot_items_sql": q_hot_items_sql,
    "sliding_url_counts": q_sliding_url_counts,
    "hot_urls_topn": q_hot_urls_topn,
    "channel_behavior_counts": q_channel_behavior_counts,
    "page_views_hourly": q_page_views_hourly,
    "page_views_salted": q_page_views_salted,
    "uv_hourly_exact": q_uv_hourly_exact,
    "uv_hourly_bitmap": q_uv_hourly_bitmap,
    "uv_hourly_running": q_uv_hourly_running,
    "uv_hourly_hll": q_uv_hourly_hll,
    "uv_daily_bitmap_merged": q_uv_daily_bitmap_merged,
    "uv_sliding_sketches": q_uv_sliding_sketches,
    "ad_clicks_passed": q_ad_clicks_passed,
    "ad_clicks_passed_wide": q_ad_clicks_passed_wide,
    "ad_blacklist_warnings": q_ad_blacklist_warnings,
    "ad_counts_by_province": q_ad_counts_by_province,
    "login_fail_consecutive": q_login_fail_consecutive,
    "login_fail_times_n": q_login_fail_times_n,
    "login_fail_times_n_wide": q_login_fail_times_n_wide,
    "login_fail_burst": q_login_fail_burst,
    "order_pay_matched": q_order_pay_matched,
    "order_pay_timeout": q_order_pay_timeout,
    "order_pay_states": q_order_pay_states,
    "order_receipt_interval_join": q_order_receipt_interval_join,
    "order_receipt_reconcile": q_order_receipt_reconcile,
    "interval_join_events": q_interval_join_events,
}


# --------------------------------------------------------------- DuckDB side

K = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _us(duration: str) -> int:
    from clickpulse.functions.timefn import to_micros
    return to_micros(duration)


def _sliding_sql(src: str, keys: list[str], size: str, slide: str, out: str = "cnt") -> str:
    s, l = _us(size), _us(slide)
    n = s // l
    k = ", ".join(keys)
    ksel = f"{k}, " if keys else ""
    return f"""
WITH src AS ({src}),
exp AS (SELECT {ksel}((epoch_us(ts) // {l}) - g) * {l} AS ws
        FROM src, generate_series(0, {n - 1}) AS t(g))
SELECT {ksel}make_timestamp(ws) AS window_start, make_timestamp(ws + {s}) AS window_end,
       count(*) AS {out}
FROM exp GROUP BY ALL"""


def _topn_sql(counts: str, key: str, n: int = 5) -> str:
    return f"""
WITH c AS ({counts}),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start, window_end
                                   ORDER BY cnt DESC, {key}) AS "rank" FROM c)
SELECT * FROM r WHERE "rank" <= {n}"""


UB = f"SELECT user_id, {K} AS item_id, ts, event_id AS seq FROM events WHERE event_type = 'view'"
LOG = (f"SELECT '/k/' || CAST({K} AS VARCHAR) AS url, ts FROM events "
       "WHERE event_type = 'click'")
MARKET = (f"SELECT list_extract(['app store', 'wechat', 'weibo', 'tieba'], "
          f"CAST(({K} % 4) + 1 AS INTEGER)) AS channel, event_type AS behavior, ts FROM events")
CLICKS = f"""SELECT e.user_id, {K} % 2 AS ad_id, n.n_name AS province, e.ts, e.event_id AS seq
FROM events e JOIN customer c ON c.c_custkey = e.user_id
JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE e.event_type = 'click'"""
RANKED_CLICKS = f"""
SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY ts, seq) AS click_no
FROM (SELECT *, CAST(ts + INTERVAL 8 HOUR AS DATE) AS day FROM ({CLICKS}))"""


def _passed_sql(most: int) -> str:
    return f"SELECT user_id, ad_id, province, ts, seq FROM ({RANKED_CLICKS}) WHERE click_no < {max(most, 2)}"


PASSED = _passed_sql(AD_MAX_CLICKS)
LOGINS = ("SELECT user_id, ts, event_id AS seq, event_type = 'error' AS fail, "
          "epoch_us(ts) AS us FROM events")
ORDER_EVENTS = """
SELECT o_orderkey AS order_id, 'create' AS event_type, o_orderdate AS ts, 0 AS seq FROM orders
UNION ALL
SELECT l.l_orderkey, 'pay', min(l.l_shipdate), 1 FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_shipdate >= o.o_orderdate GROUP BY l.l_orderkey"""
PAYS = "SELECT o_orderkey AS tx_id, o_orderdate AS pay_ts FROM orders"
RECEIPTS = ("SELECT l_orderkey AS tx_id, list_extract(['wechat', 'alipay'], "
            "CAST(l_linenumber % 2 + 1 AS INTEGER)) AS pay_channel, l_shipdate AS receipt_ts FROM lineitem")


def _bitmap_sql(col: str, cap: int) -> str:
    return (f"(list_reduce(list_transform(str_split(CAST({col} AS VARCHAR), ''), "
            f"lambda x: ascii(x)::BIGINT), lambda a, b: (a * 32 + b) & {cap - 1}) & {cap - 1})")


def _hour(col: str = "ts") -> str:
    return f"(epoch_us({col}) // {H}) * {H}"


def _login_pairs_sql(within: str, fails_only: bool, n: int | None) -> str:
    w = _us(within)
    src = f"SELECT * FROM ({LOGINS})" + (" WHERE fail" if fails_only else "")
    extra = f", CAST({n} AS BIGINT) AS n_fails" if n else ""
    step = (n - 1) if n else 1
    cond = "fail" if fails_only else "fail AND nf"
    return f"""
WITH l AS ({src}),
x AS (SELECT *, lead(fail, {step}) OVER w AS nf, lead(ts, {step}) OVER w AS nts,
             lead(seq, {step}) OVER w AS nseq, lead(us, {step}) OVER w AS nus
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq))
SELECT user_id, seq AS first_seq, ts AS first_ts, nseq AS last_seq, nts AS last_ts{extra}
FROM x WHERE {cond} AND nus IS NOT NULL AND nus - us < {w}"""


def _burst_sql(within: str) -> str:
    w = _us(within)
    open_ = f"(s.a_us IS NOT NULL AND e.us <= s.a_us + {w})"
    expired = f"(s.a_us IS NOT NULL AND e.us > s.a_us + {w})"
    return f"""
WITH RECURSIVE ev AS (
  SELECT user_id, ts, epoch_us(ts) AS us, event_type = 'error' AS fail,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
st AS (
  SELECT user_id, rn,
         CASE WHEN fail THEN us END AS a_us, CASE WHEN fail THEN ts END AS a_ts,
         CAST(CASE WHEN fail THEN 1 ELSE 0 END AS BIGINT) AS n,
         CASE WHEN fail THEN ts END AS l_ts,
         CAST(NULL AS TIMESTAMP) AS e_first, CAST(NULL AS TIMESTAMP) AS e_last,
         CAST(NULL AS BIGINT) AS e_n
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn,
         CASE WHEN e.fail THEN CASE WHEN {open_} THEN s.a_us ELSE e.us END END,
         CASE WHEN e.fail THEN CASE WHEN {open_} THEN s.a_ts ELSE e.ts END END,
         CASE WHEN e.fail THEN CASE WHEN {open_} THEN s.n + 1 ELSE 1 END ELSE 0 END,
         CASE WHEN e.fail THEN e.ts END,
         CASE WHEN {expired} THEN s.a_ts END,
         CASE WHEN {expired} THEN s.l_ts END,
         CASE WHEN {expired} THEN s.n END
  FROM st s JOIN ev e ON e.user_id = s.user_id AND e.rn = s.rn + 1),
last_rn AS (SELECT user_id, max(rn) AS rn FROM ev GROUP BY 1)
SELECT user_id, e_first AS first_ts, e_last AS last_ts, e_n AS n_fails FROM st WHERE e_n >= 2
UNION ALL
SELECT s.user_id, s.a_ts, s.l_ts, s.n FROM st s JOIN last_rn USING (user_id, rn)
WHERE s.a_us IS NOT NULL AND s.n >= 2"""


def _order_cep_sql(tag: str) -> str:
    w = _us(ORDER_WITHIN)
    sel = ("order_id, ts AS create_ts, np AS pay_ts" if tag == "matched"
           else "order_id, ts AS create_ts")
    cond = "" if tag == "matched" else "NOT "
    return f"""
WITH ev AS ({ORDER_EVENTS}),
x AS (SELECT *, min(CASE WHEN event_type = 'pay' THEN ts END) OVER (
        PARTITION BY order_id ORDER BY ts, seq
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS np FROM ev)
SELECT {sel} FROM x WHERE event_type = 'create'
AND {cond}(np IS NOT NULL AND epoch_us(np) - epoch_us(ts) < {w})"""


def _order_states_sql() -> str:
    w = _us(ORDER_WITHIN)
    return f"""
WITH ev AS ({ORDER_EVENTS}),
x AS (SELECT *, lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts,
             lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts
      FROM ev WINDOW w AS (PARTITION BY order_id ORDER BY ts, seq)),
y AS (SELECT *, nts IS NOT NULL AND epoch_us(nts) - epoch_us(ts) <= {w} AS nclose,
             pts IS NOT NULL AND epoch_us(ts) - epoch_us(pts) <= {w} AS pclose FROM x),
z AS (SELECT *, CASE
        WHEN event_type = 'create' AND nclose AND nt = 'pay' THEN 'paid'
        WHEN event_type = 'create' AND nclose THEN NULL
        WHEN event_type = 'create' THEN 'not_paid'
        WHEN pclose AND pt = 'create' THEN NULL
        ELSE 'pay_without_open_order' END AS state FROM y)
SELECT order_id, state,
       CASE WHEN event_type = 'create' THEN ts END AS create_ts,
       CASE WHEN event_type = 'pay' THEN ts WHEN state = 'paid' THEN nts END AS pay_ts
FROM z WHERE state IS NOT NULL"""


def _interval_sql(lo: str, hi: str) -> str:
    return f"""
SELECT p.tx_id, p.pay_ts, r.pay_channel, r.receipt_ts
FROM ({PAYS}) p JOIN ({RECEIPTS}) r ON p.tx_id = r.tx_id
AND epoch_us(r.receipt_ts) BETWEEN epoch_us(p.pay_ts) + ({_us_signed(lo)})
                               AND epoch_us(p.pay_ts) + ({_us_signed(hi)})"""


def _us_signed(d: str) -> int:
    d = d.strip()
    return -_us(d[1:]) if d.startswith("-") else _us(d)


def _reconcile_sql(lo: str, hi: str) -> str:
    return f"""
WITH p AS ({PAYS}), r AS ({RECEIPTS}),
m AS (SELECT p.tx_id, p.pay_ts, r.receipt_ts FROM p JOIN r ON p.tx_id = r.tx_id
      AND epoch_us(r.receipt_ts) BETWEEN epoch_us(p.pay_ts) + ({_us_signed(lo)})
                                     AND epoch_us(p.pay_ts) + ({_us_signed(hi)}))
SELECT tx_id, 'matched' AS status, pay_ts, receipt_ts FROM m
UNION ALL
SELECT tx_id, 'paid_no_receipt', pay_ts, CAST(NULL AS TIMESTAMP) FROM p
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.tx_id = p.tx_id AND m.pay_ts = p.pay_ts)
UNION ALL
SELECT tx_id, 'receipt_no_pay', CAST(NULL AS TIMESTAMP), receipt_ts FROM r
WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.tx_id = r.tx_id AND m.receipt_ts = r.receipt_ts)"""


def oracle_sql() -> dict[str, str]:
    item_counts = _sliding_sql(UB, ["item_id"], *ITEM_WINDOW)
    url_counts = _sliding_sql(LOG, ["url"], *URL_WINDOW)
    hour = _hour()
    lo, hi = EVENT_JOIN_BOUNDS
    return {
        "sliding_item_counts": item_counts,
        "hot_items_topn": _topn_sql(item_counts, "item_id"),
        "hot_items_sql": _topn_sql(item_counts, "item_id"),
        "sliding_url_counts": url_counts,
        "hot_urls_topn": _topn_sql(url_counts, "url", URL_TOP),
        "channel_behavior_counts": _sliding_sql(MARKET, ["channel", "behavior"], *CHANNEL_WINDOW),
        "page_views_hourly": _sliding_sql(UB, [], "1 hour", "1 hour", "pv"),
        "page_views_salted": _sliding_sql(UB, [], "1 hour", "1 hour", "pv"),
        "uv_hourly_exact": f"""
SELECT make_timestamp({hour}) AS window_start, make_timestamp({hour} + {H}) AS window_end,
       count(DISTINCT user_id) AS uv FROM events GROUP BY ALL""",
        "uv_hourly_bitmap": f"""
SELECT make_timestamp({hour}) AS window_start, make_timestamp({hour} + {H}) AS window_end,
       count(DISTINCT {_bitmap_sql('user_id', BITMAP_CAP)}) AS uv
FROM events WHERE event_type = 'view' GROUP BY ALL""",
        "uv_hourly_hll": f"""
SELECT make_timestamp({hour}) AS window_start, make_timestamp({hour} + {H}) AS window_end,
       count(DISTINCT user_id) AS uv, true AS within_bound
FROM events WHERE event_type = 'view' GROUP BY ALL""",
        "uv_daily_bitmap_merged": f"""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       count(DISTINCT {_bitmap_sql('user_id', BITMAP_CAP)}) AS uv
FROM events WHERE event_type = 'view' GROUP BY ALL""",
        "uv_sliding_sketches": f"""
WITH v AS (SELECT user_id, epoch_us(ts) // {H // 4} AS pane FROM events WHERE event_type = 'view'),
e AS (SELECT user_id, unnest([pane - 3, pane - 2, pane - 1, pane]) * {H // 4} AS ws FROM v)
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {H}) AS window_end,
       count(DISTINCT user_id) AS uv, true AS within_bound FROM e GROUP BY ALL""",
        "uv_hourly_running": f"""
WITH v AS (SELECT event_id AS seq, ts, {hour} AS ws, {_bitmap_sql('user_id', 1 << 30)} AS m
           FROM events WHERE event_type = 'view'),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY ws, m ORDER BY ts, seq) = 1
                THEN 1 ELSE 0 END AS first FROM v)
SELECT seq, ts, make_timestamp(ws) AS window_start, make_timestamp(ws + {H}) AS window_end,
       CAST(sum(first) OVER (PARTITION BY ws ORDER BY ts, seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS uv
FROM f""",
        "ad_clicks_passed": PASSED,
        "ad_clicks_passed_wide": _passed_sql(AD_MAX_CLICKS_WIDE),
        "ad_blacklist_warnings": f"""
SELECT user_id, ad_id, CAST(day AS VARCHAR) AS day, ts AS warn_ts, 'blacklisted' AS warning
FROM ({RANKED_CLICKS}) WHERE click_no = {max(AD_MAX_CLICKS, 2)}""",
        "ad_counts_by_province": _sliding_sql(
            f"SELECT province, ts FROM ({PASSED})", ["province"], *AD_WINDOW),
        "login_fail_consecutive": _login_pairs_sql(LOGIN_STRICT, False, None),
        "login_fail_times_n": _login_pairs_sql(LOGIN_RELAXED, True, 2),
        "login_fail_times_n_wide": _login_pairs_sql(LOGIN_RELAXED_WIDE, True, 2),
        "login_fail_burst": _burst_sql(LOGIN_BURST),
        "order_pay_matched": _order_cep_sql("matched"),
        "order_pay_timeout": _order_cep_sql("timeout"),
        "order_pay_states": _order_states_sql(),
        "order_receipt_interval_join": _interval_sql(*RECEIPT_BOUNDS),
        "order_receipt_reconcile": _reconcile_sql(*RECEIPT_BOUNDS),
        "interval_join_events": f"""
SELECT b.user_id, b.event_id AS purchase_id, b.ts AS purchase_ts,
       v.event_id AS view_id, v.ts AS view_ts
FROM events b JOIN events v ON b.user_id = v.user_id
WHERE b.event_type = 'purchase' AND v.event_type = 'view'
AND epoch_us(v.ts) BETWEEN epoch_us(b.ts) + ({_us_signed(lo)}) AND epoch_us(b.ts) + ({_us_signed(hi)})""",
    }
