"""Readers for the reference's record formats.

All fixture files are headerless, unquoted CSV split by position, except the
access log, which is space separated. Fields are read as strings and parsed
with ``try_cast`` / ``try_to_timestamp``: a malformed line yields nulls and is
dropped instead of failing the job. ``keep_malformed=True`` keeps it, with a
``_corrupt`` flag; an ``observation`` counts all and malformed lines as they
are read (``malformed_counter`` makes one).

Batch readers add ``seq``, the arrival order of the line, used to break ties
between equal timestamps: files in order of their paths, lines in order of the
file, numbered from 0 over all files. It does not depend on how the scan packs
or splits files. A stream keeps the order of arrival by itself: the keyed
processors break ties by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.functions.timefn import millis_to_ts, seconds_to_ts

#: The table of file blocks is broadcast up to this size; a row of it, hashed, takes about so many
#: bytes. 128 MiB are 1.3 million blocks: 160 TB in blocks of 128 MB.
BLOCKS_BYTES = 128 << 20
BLOCK_BYTES = 100


def _raw_csv(spark: SparkSession, path: str, names: list[str], stream: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.readStream if stream else spark.read
    df = reader.schema(schema).option("header", "false").option("quote", "\u0000").csv(path)
    return df if stream else _with_seq(df)


def _with_seq(raw: DataFrame) -> DataFrame:
    """Number the lines over all files: a file block's first number comes from
    the line counts of the blocks before it (one row per block), a line's from
    its place in the block.

    A block's rows have consecutive ids, so its lines find it by a hash of path
    and start and by lying within its ids (two blocks may share a hash). The
    block table holds four numbers a row, no paths; it is sent to every task
    while that stays under ``BLOCKS_BYTES``, so the lines are not shuffled. The
    window below orders the blocks, one row each, in one task.
    """
    rows = raw.select("*", F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_start"),
                      F.monotonically_increasing_id().alias("_row"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.groupBy("_file", "_start")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
              .select(F.xxhash64("_file", "_start").alias("_block"), "_first", "_n",
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_lines")))
    if _most_blocks(raw) * BLOCK_BYTES <= BLOCKS_BYTES:
        blocks = F.broadcast(blocks)
    place = F.col("_row") - F.col("_first")
    return (rows.withColumn("_block", F.xxhash64("_file", "_start"))
            .join(blocks, "_block").where((place >= 0) & (place < F.col("_n")))
            .withColumn("seq", F.col("_lines") + place)
            .drop("_file", "_start", "_row", "_block", "_first", "_n", "_lines"))


def _most_blocks(raw: DataFrame) -> int:
    """An upper bound of the scan's file blocks, from its plan alone: a block
    either ends its file or fills a partition."""
    return len(raw.inputFiles()) + raw.rdd.getNumPartitions()


def _long(c: str):
    return F.expr(f"try_cast(trim({c}) AS BIGINT)")


def malformed_counter(name: str = "malformed_lines") -> Observation:
    """Pass to a reader; after an action on its result ``.get`` has ``lines`` and ``malformed``."""
    return Observation(name)


def _finish(df: DataFrame, required: list[str], keep_malformed: bool,
            observation: Observation | None) -> DataFrame:
    good = F.lit(True)
    for c in required:
        good = good & F.col(c).isNotNull()
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("lines"), F.count_if(~good).alias("malformed"))
    return df.withColumn("_corrupt", ~good) if keep_malformed else df.where(good)


def read_user_behavior(spark, path, stream=False, keep_malformed=False, observation=None) -> DataFrame:
    """user_id, item_id, category_id, behavior, epoch seconds."""
    raw = _raw_csv(spark, path, ["u", "i", "c", "b", "t"], stream)
    df = raw.select(_long("u").alias("user_id"), _long("i").alias("item_id"),
                    _long("c").cast("int").alias("category_id"), F.trim("b").alias("behavior"),
                    seconds_to_ts(_long("t")).alias("ts"), *([] if stream else ["seq"]))
    return _finish(df, ["user_id", "item_id", "behavior", "ts"], keep_malformed, observation)


def read_access_log(spark, path, stream=False, keep_malformed=False, observation=None) -> DataFrame:
    """Space-split log; 0 ip, 1 user, 3 dd/MM/yyyy:HH:mm:ss, 5 method, 6 url."""
    reader = spark.readStream if stream else spark.read
    raw = reader.text(path)
    if not stream:
        raw = _with_seq(raw)
    parts = F.split(F.col("value"), " ")
    fmt = F.lit("dd/MM/yyyy:HH:mm:ss")
    text = F.try_element_at(parts, F.lit(4))
    # try_to_timestamp only validates (it never raises); the wall clock itself is
    # parsed as timestamp_ntz, which involves no time zone. CASE evaluates the
    # strict parser only for valid text.
    ts = F.when(F.try_to_timestamp(text, fmt).isNotNull(), F.to_timestamp_ntz(text, fmt))
    df = raw.select(F.try_element_at(parts, F.lit(1)).alias("ip"),
                    F.try_element_at(parts, F.lit(2)).alias("user"),
                    ts.alias("ts"),
                    F.try_element_at(parts, F.lit(6)).alias("method"),
                    F.try_element_at(parts, F.lit(7)).alias("url"),
                    *([] if stream else ["seq"]))
    return _finish(df, ["ts", "method", "url"], keep_malformed, observation)


def read_ad_clicks(spark, path, stream=False, keep_malformed=False, observation=None) -> DataFrame:
    """S3: user_id, ad_id, province, city, epoch seconds."""
    raw = _raw_csv(spark, path, ["u", "a", "p", "c", "t"], stream)
    df = raw.select(_long("u").alias("user_id"), _long("a").alias("ad_id"),
                    F.trim("p").alias("province"), F.trim("c").alias("city"),
                    seconds_to_ts(_long("t")).alias("ts"), *([] if stream else ["seq"]))
    return _finish(df, ["user_id", "ad_id", "ts"], keep_malformed, observation)


def read_logins(spark, path, stream=False, keep_malformed=False, observation=None) -> DataFrame:
    """user_id, ip, event_type (success / fail), epoch seconds."""
    raw = _raw_csv(spark, path, ["u", "ip", "e", "t"], stream)
    df = raw.select(_long("u").alias("user_id"), F.trim("ip").alias("ip"),
                    F.trim("e").alias("event_type"), seconds_to_ts(_long("t")).alias("ts"),
                    *([] if stream else ["seq"]))
    return _finish(df, ["user_id", "event_type", "ts"], keep_malformed, observation)


def read_orders(spark, path, stream=False, keep_malformed=False, observation=None) -> DataFrame:
    """order_id, event_type (create / pay), tx_id (empty on create), epoch seconds."""
    raw = _raw_csv(spark, path, ["o", "e", "x", "t"], stream)
    tx = F.trim("x")
    df = raw.select(_long("o").alias("order_id"), F.trim("e").alias("event_type"),
                    F.when(tx != "", tx).alias("tx_id"), seconds_to_ts(_long("t")).alias("ts"),
                    *([] if stream else ["seq"]))
    return _finish(df, ["order_id", "event_type", "ts"], keep_malformed, observation)


def read_receipts(spark, path, stream=False, keep_malformed=False, observation=None) -> DataFrame:
    """tx_id, pay_channel, epoch seconds."""
    raw = _raw_csv(spark, path, ["x", "c", "t"], stream)
    df = raw.select(F.trim("x").alias("tx_id"), F.trim("c").alias("pay_channel"),
                    seconds_to_ts(_long("t")).alias("ts"), *([] if stream else ["seq"]))
    return _finish(df, ["tx_id", "ts"], keep_malformed, observation)


def market_behavior(df: DataFrame, ts_millis: str = "ts_ms") -> DataFrame:
    """Any table or stream of (user_id, behavior, channel, epoch ms)."""
    return df.withColumn("ts", millis_to_ts(F.col(ts_millis))).drop(ts_millis)
