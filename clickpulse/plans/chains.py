"""Chains of jumps along a key's time order, followed without a driver loop.

A node (us, v) of a key may jump to one later node of the key, at most
``reach`` ahead. Wanted is every node that a flagged node leads to, itself
included. Nodes are grouped by time chunk and a chunk's chains are followed
in order. A chain from outside can enter a chunk only at a node within
``reach`` of its start, so a chunk also reports, for each such entry, the
nodes it would lead to and where it would leave. The entries and exits of
the chunks are chains again, of far fewer nodes: they are followed in blocks
of ``FAN_OUT`` chunks, and those of the blocks once per key. Two joins on the
entries then tell which of the reported nodes are really reached.

The rounds are fixed and no job runs while the plan is built. A task holds
one chunk, or the entries of one block: about reach / width of its nodes; the
last round takes that share of that share, over ``FAN_OUT``, for a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN_OUT = 64
#: Kinds of a round's rows: a reached node; the exit (to_us, to_v) of an entry (us, v); a node of a later
#: block that a chain of this one reaches; a node (us, v) that the entry (to_us, to_v) would lead to.
REACHED, EXIT, CALL, WOULD = range(4)
_LONGS = ("us", "v", "to_us", "to_v", "n", "last_us")


def _follow(nodes: dict, flags: list, end: int | None, upto: int | None) -> Iterator[tuple]:
    """The rows of one block. ``nodes``: (us, v) -> (to, facts) in order, ``flags``: flagged nodes in order."""
    seen = set()

    def walk(node):
        """The nodes from ``node`` on inside the block, and the node at which the chain leaves it."""
        path = []
        while node is not None and (end is None or node[0] < end):
            path.append(node)
            node = nodes.get(node, (None,))[0]
        return path, node

    for flag in flags:
        if flag in seen:
            continue
        path, out = walk(flag)
        for node in path:
            if node in seen:
                out = None              # met an earlier chain: the rest has been told
                break
            seen.add(node)
            yield REACHED, *node, None, None, *nodes.get(node, (None, (None, None)))[1]
        if out is not None:
            yield CALL, *out, None, None, None, None
    if upto is None:
        return
    for entry in nodes:
        if entry[0] >= upto:
            break
        path, out = walk(entry)
        for node in path:
            yield WOULD, *node, *entry, *nodes.get(node, (None, (None, None)))[1]
        if out is not None:
            yield EXIT, *entry, *out, None, None


def _round(key: str, field: T.StructField, block: str, width: int | None, reach: int):
    """``mapInArrow`` function of one round over rows sorted by (key, block, us, v), and its schema."""
    schema = T.StructType([field, T.StructField("kind", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in _LONGS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_type = None
        out: list[tuple] = []
        now, nodes, flags = None, {}, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 8
            types = [key_type, pa.int32()] + [pa.int64()] * 6
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [key, "kind", *_LONGS])
            out.clear()
            return batch

        def close():
            start = None if width is None else now[1] * width
            ends = (None, None) if start is None else (start + width, start + reach)
            out.extend((now[0], *row) for row in _follow(nodes, flags, *ends))

        for batch in batches:
            key_type = batch.schema.field(key).type
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in (key, block, "us", "v", "to_us", "to_v", "flag", "n", "last_us")]
            for k, b, us, v, to_us, to_v, flag, n, last_us in zip(*columns):
                if now is None or now != (k, b):
                    if now is not None:
                        close()
                    now, nodes, flags = (k, b), {}, []
                    if len(out) >= 10_000:
                        yield flush()
                if flag:
                    flags.append((us, v))
                if to_us is not None or n is not None:
                    nodes[us, v] = (None if to_us is None else (to_us, to_v)), (n, last_us)
        if now is not None:
            close()
            yield flush()

    return run, schema


def reached(nodes: DataFrame, key: str, chunk: str, width: int, reach: int) -> DataFrame:
    """The nodes (``key``, us, v, n, last_us) that the flagged ones lead to.

    ``nodes`` has ``key``, ``chunk`` (= us div ``width``), us, v, to_us, to_v
    (null: no jump), flag, and n (not null) and last_us, which are handed
    through. Jumps go at most ``reach`` ahead, which is at most ``width``.
    """
    field, block = nodes.schema[key], "_block"

    def follow(rows: DataFrame, by: str, size: int | None) -> DataFrame:
        run, schema = _round(key, field, by, size, reach)
        return (rows.select(key, by, *_LONGS, "flag").repartition(key, by)
                .sortWithinPartitions(key, by, "us", "v").mapInArrow(run, schema))

    def above(rows: DataFrame, number) -> DataFrame:
        return rows.where(F.col("kind").isin(EXIT, CALL)).select(
            key, *_LONGS, (F.col("kind") == CALL).alias("flag"), number.cast("bigint").alias(block))

    def true_ones(rows: DataFrame, entered: DataFrame) -> DataFrame:
        """The reached nodes of a round: its own, and those that a true entry would lead to."""
        e = entered.select(F.col(key).alias("_k"), F.col("us").alias("_us"), F.col("v").alias("_v")).distinct()
        found = rows.where(F.col("kind").isin(REACHED, WOULD)).join(
            e, (F.col("kind") == WOULD) & F.col(key).eqNullSafe(F.col("_k")) & (F.col("to_us") == F.col("_us"))
            & (F.col("to_v") == F.col("_v")), "left")
        return found.where((F.col("kind") == REACHED) | F.col("_us").isNotNull()).select(key, "us", "v", "n", "last_us")

    big = width * FAN_OUT
    in_chunks = follow(nodes, chunk, width)
    in_blocks = follow(above(in_chunks, F.floor(F.col("us") / F.lit(big))), block, big)
    of_keys = follow(above(in_blocks, F.lit(0)), block, None)
    into_blocks = of_keys.where(F.col("kind") == REACHED).select(key, "us", "v")
    # a block knows an entry only if its chain goes on: the others are added
    into_chunks = true_ones(in_blocks, into_blocks).select(key, "us", "v").unionByName(into_blocks)
    return true_ones(in_chunks, into_chunks)
