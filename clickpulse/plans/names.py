"""Names for working columns that cannot clash with an input's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(name: str, *inputs: DataFrame) -> str:
    """``name``, with underscores before it until no input has such a column (names ignore case)."""
    taken = {c.lower() for df in inputs for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
