"""Lineage cutting for iterative plans."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickpulse.session import checkpoint_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder (reliable checkpoint).

    Used between rounds of iterative algorithms so plans stay small and a
    lost executor recomputes from the checkpoint, not from the first round.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
