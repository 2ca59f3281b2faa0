"""Aggregation helpers for skewed keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.hashing import salt


def salted_count(df: DataFrame, keys: list[str], salt_by: str, buckets: int = 8,
                 out: str = "cnt") -> DataFrame:
    """Two-phase count: by (salt, keys), then sum by keys.

    Spark already combines map-side; the explicit salt additionally spreads
    the reduce side of a hot key over ``buckets`` tasks. The salt is a hash
    of ``salt_by`` (deterministic, so a recomputed task gets the same rows).
    """
    part = (df.groupBy(salt(F.col(salt_by), buckets).alias("_salt"), *keys)
            .agg(F.count(F.lit(1)).alias("_c")))
    return part.groupBy(*keys).agg(F.sum("_c").cast("bigint").alias(out))
