"""Readers for the reference record formats, fed with lines derived from the driver tables."""

import os
import tempfile

from pyspark.sql import functions as F

from clickpulse import operators as op
from clickpulse.sources import market_behavior, read_access_log, read_user_behavior
from clickpulse.sources import testdata as td
from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _epoch_s(col):
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(col))


def test_access_log_round_trip(spark):
    log = td.access_log(spark, SF_SMALL).withColumn("ts", F.date_trunc("second", "ts"))
    lines = log.select(F.concat_ws(" ", F.lit("10.0.0.1"), F.col("user"), F.lit("-"),
                                   F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
                                   F.col("method"), F.col("url")).alias("value"))
    path = os.path.join(tempfile.mkdtemp(prefix="clickpulse-log-"), "apache.log")
    lines.coalesce(1).write.text(path)
    parsed = read_access_log(spark, path)
    assert parsed.count() == log.count()
    a = op.url_counts(parsed, "10 minutes", "5 seconds")
    b = op.url_counts(log, "10 minutes", "5 seconds")
    assert _same(a, b)


def test_access_log_skips_malformed(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="clickpulse-log-"), "bad.log")
    with open(path, "w") as f:
        f.write("10.0.0.1 u - 17/05/2015:10:05:03 +0000 GET /a\n")
        f.write("garbage line\n")
        f.write("10.0.0.2 u - 99/99/2015:10:05:03 +0000 GET /b\n")
    rows = read_access_log(spark, path).collect()
    assert [(r.url, str(r.ts)) for r in rows] == [("/a", "2015-05-17 10:05:03")]
    assert read_access_log(spark, path, keep_malformed=True).count() == 3


def test_user_behavior_csv_round_trip(spark):
    ub = td.user_behavior(spark, SF_SMALL).withColumn("ts", F.date_trunc("second", "ts"))
    csv = ub.select("user_id", "item_id", (F.col("item_id") % 10).alias("category_id"),
                    "behavior", _epoch_s("ts").alias("t"))
    path = os.path.join(tempfile.mkdtemp(prefix="clickpulse-ub-"), "UserBehavior.csv")
    csv.coalesce(1).write.csv(path)
    parsed = read_user_behavior(spark, path)
    a = op.item_counts(parsed, "1 hour", "5 minutes")
    b = op.item_counts(ub, "1 hour", "5 minutes")
    assert _same(a, b)


def test_market_behavior_from_millis(spark):
    mk = td.market_events(spark, SF_SMALL)
    ms = mk.select("user_id", "behavior", "channel",
                   F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                    F.col("ts")).alias("ts_ms"))
    back = market_behavior(ms)
    a = op.channel_behavior_counts(back, "1 hour", "5 minutes")
    b = op.channel_behavior_counts(mk.withColumn("ts", F.date_trunc("millisecond", "ts")),
                                   "1 hour", "5 minutes")
    assert _same(a, b)
    assert {r.channel for r in mk.select("channel").distinct().collect()} <= {
        "app store", "wechat", "weibo", "tieba"}


def test_render_topn_report(spark):
    top = op.hot_items(td.user_behavior(spark, SF_SMALL), 3, "1 hour", "5 minutes")
    rep = op.render_topn(top, "item_id", "itemId")
    one = top.orderBy("window_end", "rank").first()
    line = rep.where(F.col("window_end") == one.window_end).first().report.split("\n")
    assert line[0].startswith("window end: ")
    assert line[1] == f"No1: itemId={one.item_id} count={one.cnt}"
    assert rep.count() == top.select("window_end").distinct().count()


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(f"{r}\n" for r in rows))


def test_malformed_lines_are_counted_and_flagged(spark):
    from clickpulse.sources import malformed_counter, read_logins
    folder = tempfile.mkdtemp(prefix="clickpulse-bad-")
    _write(folder, "a.csv", ["1,ip,fail,100", "x,ip,fail,101", "2,ip,success,oops", "3,ip,fail,103", "4"])
    seen = malformed_counter()
    assert read_logins(spark, folder, observation=seen).count() == 2
    assert seen.get == {"lines": 5, "malformed": 3}
    kept = read_logins(spark, folder, keep_malformed=True).orderBy("seq").collect()
    assert [r._corrupt for r in kept] == [False, True, True, False, True]


def test_seq_follows_paths_and_lines_however_files_are_packed(spark):
    from clickpulse.sources import read_access_log, read_logins
    folder = tempfile.mkdtemp(prefix="clickpulse-seq-")
    files = {"a.csv": 1, "b.csv": 50, "c.csv": 0, "d.csv": 3000}
    users = iter(range(10_000))
    want = []
    for name, n in files.items():
        mine = [next(users) for _ in range(n)]
        want += mine
        _write(folder, name, [f"{u},ip,fail,100" for u in mine])
    for size in ("128m", "4k", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        try:
            got = read_logins(spark, folder).orderBy("seq").select("user_id", "seq").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert [r.user_id for r in got] == want, size
        assert [r.seq for r in got] == list(range(len(want))), size
    logs = tempfile.mkdtemp(prefix="clickpulse-seq-")
    _write(logs, "1.log", ["10.0.0.1 u - 17/05/2015:10:05:03 +0000 GET /a"])
    _write(logs, "2.log", [f"10.0.0.1 u - 17/05/2015:10:05:03 +0000 GET /{k}" for k in range(20)])
    got = read_access_log(spark, logs).orderBy("seq").collect()
    assert [r.url for r in got] == ["/a", *[f"/{k}" for k in range(20)]]


def test_seq_beyond_the_broadcast_bound(spark, monkeypatch):
    """Lines are numbered alike whether their block table is broadcast or too large for that."""
    from clickpulse.sources import read_logins, readers
    folder = tempfile.mkdtemp(prefix="clickpulse-seq-")
    for k in range(5):
        _write(folder, f"{k}.csv", [f"{100 * k + i},ip,fail,100" for i in range(40)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    # the threshold keeps Spark from broadcasting by its own estimate
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = read_logins(spark, folder)
        assert "BroadcastHashJoin" in plan(sent) and "SortMergeJoin" not in plan(sent)
        want = [(r.seq, r.user_id) for r in sent.orderBy("seq").collect()]
        monkeypatch.setattr(readers, "BLOCKS_BYTES", 0)
        dealt = read_logins(spark, folder)
        assert "SortMergeJoin" in plan(dealt)
        assert [(r.seq, r.user_id) for r in dealt.orderBy("seq").collect()] == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [s for s, _ in want] == list(range(200))


def test_reconcile_one_to_one(spark):
    at = lambda s: f"timestamp_ntz'2024-01-01 00:00:{s:02d}'"
    pays = spark.sql(f"SELECT * FROM VALUES ('a', {at(10)}), ('a', {at(12)}), ('b', {at(10)}) AS t(tx_id, pay_ts)")
    recs = spark.sql(f"SELECT * FROM VALUES ('a', {at(11)}), ('a', {at(14)}), ('c', {at(9)}) AS t(tx_id, receipt_ts)")
    many = op.reconcile(pays, recs).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in many} == {"matched": 4, "paid_no_receipt": 1, "receipt_no_pay": 1}
    one = op.reconcile(pays, recs, dedupe_tx=True).collect()
    assert sorted((r.tx_id, r.status) for r in one) == [("a", "matched"), ("b", "paid_no_receipt"),
                                                         ("c", "receipt_no_pay")]
    match = next(r for r in one if r.status == "matched")
    assert (match.pay_ts.second, match.receipt_ts.second) == (10, 11)


def test_changelog_compaction_keeps_the_newest_rows(spark):
    from clickpulse.sources.sinks import changelog_sink, compact_changelog, read_latest
    root = tempfile.mkdtemp(prefix="clickpulse-log-")
    log, new = f"{root}/log", f"{root}/new"

    def batch(rows):
        return spark.createDataFrame(rows, "k string, cnt long")
    for epoch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 5)]]):
        changelog_sink(log)(batch(rows), epoch)
    assert compact_changelog(spark, log, new, ["k"]) == 2
    changelog_sink(new)(batch([("b", 7)]), 3)
    assert sorted(tuple(r) for r in read_latest(spark, new, ["k"]).collect()) == [("a", 2), ("b", 7), ("c", 5)]
    assert spark.read.parquet(new).count() == 4


def test_open_windows_are_not_ranked(spark):
    import datetime
    from clickpulse import streaming as st
    root = tempfile.mkdtemp(prefix="clickpulse-fired-")
    src = f"{root}/src"
    os.makedirs(src)
    log = td.access_log(spark, SF_SMALL)
    pdf = log.orderBy("ts", "seq").toPandas()
    from clickpulse.sources.sinks import changelog_sink
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (st.url_counts_with_lateness(stream, "10 minutes", "1 minute", "2 seconds", "1 minute")
         .writeStream.outputMode("update").foreachBatch(changelog_sink(f"{root}/out"))
         .option("checkpointLocation", f"{root}/ck").start())
    try:
        for part in (pdf.iloc[:100], pdf.iloc[100:101]):
            spark.createDataFrame(part, schema=log.schema).coalesce(1).write.mode("append").parquet(src)
            q.processAllAvailable()
        mark = st.fired_watermark(q)
    finally:
        q.stop()
    newest = pdf.iloc[100].ts.to_pydatetime()
    assert abs((newest - datetime.timedelta(seconds=2) - mark).total_seconds()) < 1
    every = st.top_n_from_changelog(spark, f"{root}/out", ["url"], 5)
    fired = st.top_n_from_changelog(spark, f"{root}/out", ["url"], 5, watermark=mark)
    ends = [r.window_end for r in fired.collect()]
    assert 0 < len(ends) < every.count() and max(ends) <= mark
