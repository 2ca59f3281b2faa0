"""Role mapping from the driver's tables to the reference's record types.

``events`` is sparse (one row every ~26 s at sf 0.1, one user's rows hours
apart), so each role keeps the reference's record shape while registered
queries use time bounds scaled to the data (see the registry).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The four marketing channels named by the reference's generator.
CHANNELS = ["app store", "wechat", "weibo", "tieba"]
# The two payment channels in the reference's receipt log.
PAY_CHANNELS = ["wechat", "alipay"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k():
    return F.expr("try_cast(get_json_object(props, '$.k') AS BIGINT)")


def user_behavior(spark, sf_dir, pv_only: bool = False) -> DataFrame:
    """UserBehavior: views are page views (``pv``).

    ``pv_only`` filters on the stored ``event_type`` so the predicate reaches
    the Parquet scan; the operators' ``behavior = 'pv'`` then folds away.
    """
    ev = table(spark, sf_dir, "events")
    if pv_only:
        ev = ev.where(F.col("event_type") == "view")
        behavior = F.lit("pv")
    else:
        behavior = F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type"))
    return ev.select("user_id", _k().alias("item_id"), behavior.alias("behavior"), "ts",
                     F.col("event_id").alias("seq"))


def access_log(spark, sf_dir) -> DataFrame:
    """ApacheLog: clicks are GET requests of ``/k/<k>``."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    return ev.select(F.col("user_id").cast("string").alias("user"), "ts",
                     F.lit("GET").alias("method"),
                     F.concat(F.lit("/k/"), _k().cast("string")).alias("url"),
                     F.col("event_id").alias("seq"))


def market_events(spark, sf_dir) -> DataFrame:
    """MarketUserBehavior: every event; channel from ``k % 4``."""
    ev = table(spark, sf_dir, "events")
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]),
                           (F.pmod(_k(), F.lit(len(CHANNELS))) + 1).cast("int"))
    return ev.select("user_id", F.col("event_type").alias("behavior"), channel.alias("channel"),
                     "ts", F.col("event_id").alias("seq"))


def ad_clicks(spark, sf_dir) -> DataFrame:
    """AdClickEvent without its geography: clicks; ad = ``k % 2``."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    return ev.select("user_id", F.pmod(_k(), F.lit(2)).alias("ad_id"), "ts",
                     F.col("event_id").alias("seq"))


def with_province(spark, sf_dir, clicks: DataFrame) -> DataFrame:
    """``clicks`` of known users with their province (the user's nation name)."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                                   F.col("n_name").alias("province"))
    geo = cust.join(nation, "c_nationkey").select("user_id", "province")
    return clicks.join(geo, on="user_id", how="inner")


def logins(spark, sf_dir) -> DataFrame:
    """LoginEvent: ``error`` events are failed logins, everything else succeeds."""
    ev = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success"))
    return ev.select("user_id", kind.alias("event_type"), "ts", F.col("event_id").alias("seq"))


def order_events(spark, sf_dir) -> DataFrame:
    """OrderEvent log: each order is created at its order date and paid at its
    first ship date on or after that date (if any)."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"),
                                                   F.col("o_orderdate").alias("ts"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"),
                                                 F.col("l_shipdate").alias("ship"))
    pays = (li.join(orders, on="order_id")
            .where(F.col("ship") >= F.col("ts"))
            .groupBy("order_id").agg(F.min("ship").alias("ts")))
    creates = orders.select("order_id", F.lit("create").alias("event_type"),
                            F.lit(None).cast("string").alias("tx_id"), "ts", F.lit(0).alias("seq"))
    paid = pays.select("order_id", F.lit("pay").alias("event_type"),
                       F.concat(F.lit("tx"), F.col("order_id").cast("string")).alias("tx_id"),
                       "ts", F.lit(1).alias("seq"))
    return creates.unionByName(paid)


def pays(spark, sf_dir) -> DataFrame:
    """Pay events keyed by tx: every order at its order date."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tx_id"),
                                                 F.col("o_orderdate").alias("ts"))


def receipts(spark, sf_dir) -> DataFrame:
    """ReceiptEvent: every line of every order at its ship date; channel from the line number."""
    ch = F.element_at(F.array(*[F.lit(c) for c in PAY_CHANNELS]),
                      (F.pmod(F.col("l_linenumber"), F.lit(2)) + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tx_id"),
                                                   ch.alias("pay_channel"), F.col("l_shipdate").alias("ts"))
