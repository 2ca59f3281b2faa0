"""Exact deduplication with a two-pass Bloom filter.

Pass 1 turns every text into a SHA-256 key, counts 64-bit hashes of the keys
and sets the Bloom slots of those that occur at least twice: the filter of
*possibly repeated* keys. Pass 2 asks the filter at each row: rows it rejects
are certainly unique and go straight to the output, only the others are
shuffled by key and grouped. A false positive costs a shuffle of that row,
never a wrong result.

The hashes are counted by a shuffle of one number a row, so pass 1 has no size
limit; the filter holds one entry per repeated text, not per row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import WHITE, materialize, shielded, without

#: Bits per repeated text aimed for, and the largest filter that is broadcast
#: (2^30 bits = 128 MiB): the bound of the broadcast, whatever the input size.
BITS_PER_ENTRY = 16
MAX_FILTER_BITS = 1 << 30
_SEEDS = (11, 23)


def normalized(text: Column) -> Column:
    """Runs of ASCII white space become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def text_key(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _slots(hashed: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(hashed, F.lit(s)), F.lit(bits)) for s in _SEEDS]


def filter_bits(entries: int, max_bits: int = MAX_FILTER_BITS) -> int:
    """A power of two of at least 2^16 and at most ``max_bits`` bits."""
    want = 1 << 16
    while want < entries * BITS_PER_ENTRY and want < max_bits:
        want <<= 1
    return min(want, max_bits)


def repeated_hashes(keys: DataFrame, key: str) -> DataFrame:
    """(h): the hashes that two or more rows of ``keys`` share, counted with map-side partial sums."""
    return (keys.groupBy(_hash(F.col(key)).alias("h")).agg(F.count(F.lit(1)).alias("n"))
            .where("n >= 2").select("h"))


def bloom_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bitset of the slots of ``hashes`` (h).

    Spark packs the slots into 64-bit words; the driver receives at most
    ``bits / 64`` of them.
    """
    slots = hashes.select(F.explode(F.array(*_slots(F.col("h"), bits))).alias("s"))
    words = (slots.groupBy(F.shiftright("s", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("b")))
    got = words.toArrow()
    bitset = np.zeros(bits // 64, dtype=np.uint64)
    if got.num_rows:
        w = got.column("w").to_numpy()
        bitset[w] = got.column("b").to_numpy().view(np.uint64)
    return bitset


@shielded
def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """Every row of ``docs`` plus ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after :func:`normalized`. The row with the
    smallest id of a group stays (``kept``). Defined edge cases: a null text
    equals the empty text; null ids sort last and such a row stays only if all
    ids of its group are null; rows repeating the smallest id: exactly one of
    them stays, the first by the hash of all columns (the others are dropped copies);
    a very long text is only hashed; an empty table gives an empty
    result; input columns named like an output column are replaced.
    """
    spark = docs.sparkSession
    docs = without(docs, "keep_id", "group_size", "kept", "text_sha256")
    cols = docs.columns
    keyed = docs.withColumn("text_sha256", text_key(F.col(text_col)))
    hashes = materialize(repeated_hashes(keyed, "text_sha256"), "repeated-hashes")
    bits = filter_bits(hashes.count(), max_filter_bits)
    bitset = spark.sparkContext.broadcast(bloom_filter(hashes, bits))

    @F.pandas_udf("boolean")
    def possibly_repeated(a: pd.Series, b: pd.Series) -> pd.Series:
        hit = np.ones(len(a), dtype=bool)
        for s in (a, b):
            v = s.to_numpy().astype(np.uint64)
            hit &= ((bitset.value[(v >> np.uint64(6)).astype(np.int64)] >> (v & np.uint64(63)))
                    & np.uint64(1)).astype(bool)
        return pd.Series(hit)

    asked = keyed.withColumn("__maybe", possibly_repeated(*_slots(_hash(F.col("text_sha256")), bits)))
    id_type = docs.schema[id_col].dataType
    out = [F.col(f"d.`{c}`") for c in cols]
    once = (asked.where("NOT __maybe").alias("d")
            .select(*out, F.col(id_col).cast(id_type).alias("keep_id"),
                    F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"),
                    "text_sha256"))

    # rows that share key and id are numbered; (key, id) spreads a hot key over all tasks
    w = Window.partitionBy("text_sha256", id_col).orderBy(F.xxhash64(*cols))
    many = asked.where("__maybe").withColumn("__copy", F.row_number().over(w))
    groups = many.groupBy("text_sha256").agg(
        F.min(id_col).alias("__keep"), F.count(F.lit(1)).alias("__size"))
    several = (many.alias("d").join(groups.alias("g"), F.col("d.text_sha256") == F.col("g.text_sha256"))
               .select(*out, F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
                       (F.col(f"d.`{id_col}`").eqNullSafe(F.col("__keep")) & (F.col("__copy") == 1)).alias("kept"),
                       F.col("d.text_sha256").alias("text_sha256")))
    return once.unionByName(several)
