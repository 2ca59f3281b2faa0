"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from clickpulse.session import checkpoint_dir

#: ASCII white space of the contracts: space and TAB..CR.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` minus the columns an operator is about to add (its own output wins)."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (seen by every executor)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back; ``options`` go to the writer.

    Cuts the lineage like a reliable checkpoint, but compressed and columnar,
    so later passes read only the columns they need.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.options(**options).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when each query ends, not when the driver collects its garbage.

    For jobs that write every step: what a step has shuffled is never read again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator on rows whose working columns, all named ``__...``, cannot meet columns of its input.

    Input columns named so go through under other names and get their own
    back in the result; without such columns nothing changes.
    """
    @wraps(operator)
    def run(docs: DataFrame, *args, **named) -> DataFrame:
        taken = {c.lower() for c in docs.columns}
        other: dict[str, str] = {}
        for c in docs.columns:
            if c.startswith("__"):
                name = "kept" + c
                while name.lower() in taken:
                    name = "kept_" + name
                taken.add(name.lower())
                other[c] = name
        if not other:
            return operator(docs, *args, **named)
        new = lambda v: other.get(v, v) if isinstance(v, str) else v
        out = operator(docs.withColumnsRenamed(other), *map(new, args), **{k: new(v) for k, v in named.items()})
        return out.withColumnsRenamed({name: c for c, name in other.items()})
    return run
