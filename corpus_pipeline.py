"""Training-data pipeline over ``documents``: five stages, each an operator of ``clickpulse.llm``.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps;
``run`` writes each result as Parquet in the shared checkpoint folder and
reads it back for the next stage, so a lost executor never repeats more than
the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.common import materialize, table
from clickpulse.llm.decontaminate import decontaminate
from clickpulse.llm.line_dedup import line_dedup
from clickpulse.llm.mixing import mix_sources
from clickpulse.llm.queries import MIX_BLOCK_ROWS, MIX_WEIGHTS, crc_fold
from clickpulse.llm.simhash import simhash_dedup
from clickpulse.llm.toxicity import toxicity, train_on


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic (score below 0.7); learns only from non-held-out labels."""
    learn = F.coalesce(crc_fold("doc_id", 3) != 1, F.lit(True))
    model = train_on(docs, table(spark, sf_dir, "labels"), learn)
    return toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line; ``n_chars`` follows the text."""
    out = line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (three-word shingles, at most three bits)."""
    return simhash_dedup(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix of the sources."""
    return mix_sources(docs, MIX_WEIGHTS, block_rows=MIX_BLOCK_ROWS)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", dedup_near),
    ("decontamination", drop_benchmark),
    ("mix", mix),
]

#: No SQL can express the learned, hashed and aligned stages; tests hold them
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
