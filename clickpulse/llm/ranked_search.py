"""Ranked lexical search with bag deduplication.

For a ranking only a document's words that some item asks for, and its
length term m, matter. Every text is therefore cut down to its vector of
(term, occurrences) over the items' vocabulary; documents with the same
vector and m form a class (met by hash, verified by value). Classes are
scored once against all items; of a class only the ``top`` smallest ids can
ever be ranked, so only they travel with it, and they are expanded into the
ranking in ascending order.

Items are taken in blocks of ``ITEM_BLOCK``, so that what a task holds (the
block's vocabulary and its table of term weights) is bounded whatever the
number of items; every block reads all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.llm.common import materialize

#: Items scored together, and their vocabulary: a block ends at either bound (an item alone may exceed the second).
ITEM_BLOCK = 512
BLOCK_TERMS = 20_000
#: Cells (classes x items) of one scoring step.
STEP_CELLS = 1 << 20
#: Bytes of a text cut into terms at once.
TEXT_BLOCK = 1 << 20

# every byte that cannot be in a term becomes a space; A-Z become a-z; bytes of other letters stay
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_VECTORS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("vec", pa.binary())])


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in blocks of bounded size; null has none."""
    text, at = text or b"", 0
    while at < len(text):
        end, cut = at + TEXT_BLOCK, len(text)
        if end < len(text):
            cut = _term_end(text, end)
        yield text[at:cut].translate(_FOLD).split()
        at = cut


def _term_end(text: bytes, at: int) -> int:
    """The first place from ``at`` on that is not inside a term."""
    while at < len(text):
        gap = text[at:at + 4096].translate(_FOLD).find(b" ")
        if gap >= 0:
            return at + gap
        at += 4096
    return len(text)


def _pack(counts: Counter) -> bytes:
    """(term number, occurrences) in ascending order of the number; equal vectors give equal bytes."""
    return np.array(sorted(counts.items()), "<u4").tobytes()


def vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n, vec) per document: its number of terms and its vector over ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            n, vec = [], []
            for text in batch.column(1):
                total, counts = 0, Counter()
                for found in terms(text.as_py()):
                    total += len(found)
                    counts.update(map(number, found))
                counts.pop(None, None)
                n.append(total)
                vec.append(_pack(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(vec, pa.binary())],
                                             schema=_VECTORS)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(cut, T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()),
                                              T.StructField("vec", T.BinaryType())]))


def document_frequency(found: DataFrame, size: int) -> np.ndarray:
    """Per term number, the documents that hold it: counted per task, then summed by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for vec in batch.column(0):
                df[np.frombuffer(vec.as_py(), "<u4")[::2]] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held], pa.int64())], ["t", "df"])

    rows = (found.select("vec").where("length(vec) > 0").mapInArrow(count, "t long, df long")
            .groupBy("t").agg(F.sum("df").alias("df")).toArrow())
    out = np.zeros(size, np.int64)
    out[rows.column("t").to_numpy()] = rows.column("df").to_numpy()
    return out


def weight(docs: int, df: int) -> int:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def classes(found: DataFrame, docs: int, length: int, top: int) -> DataFrame:
    """(vec, m, ids): the distinct vectors with m, each with its ``top`` smallest ids in ascending order.

    ``h`` brings the members together, the grouping compares the vectors
    themselves. Members beyond ``top`` are left behind before the exchange,
    so a class holding a third of all documents moves a few rows a task.
    """
    m = F.expr(f"{100 - 25} + ((25 * n * {docs}L) div {length}L)")
    rows = (found.where("length(vec) > 0").select("id", "vec", m.alias("m"))
            .withColumn("h", F.xxhash64("vec", "m")))
    key = Window.partitionBy("h", "m", "vec").orderBy(F.col("id").asc_nulls_last())
    return (rows.withColumn("r", F.row_number().over(key)).where(F.col("r") <= top)
            .groupBy("h", "m", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.count(F.lit(1)).alias("k"))
            # collect_list leaves nulls out: they come last
            .select("vec", "m", F.concat("ids", F.array_repeat(F.lit(None).cast("bigint"),
                                                               (F.col("k") - F.size("ids")).cast("int"))).alias("ids")))


_LAST = (1 << 63) - 1


def _order(id_):
    return (id_ is None, _LAST if id_ is None else id_)


def best(found: DataFrame, weights: np.ndarray, top: int) -> DataFrame:
    """(item, id, score): per task and item of the block the ``top`` best documents.

    Classes of equal score are kept by their smallest id: a document among
    the first ``top`` can only sit in one of the first ``top`` classes in
    this order.
    """
    shared = found.sparkSession.sparkContext.broadcast(weights)
    step = max(1, STEP_CELLS // weights.shape[1])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        kept: list[list] = [[] for _ in range(w.shape[1])]
        floor = np.zeros(w.shape[1], np.int64)          # the score a class needs to be looked at
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                vecs, ms, ids = part.column(0), part.column(1).to_numpy(), part.column(2)
                table = np.zeros((part.num_rows, w.shape[1]), np.int64)
                for i, vec in enumerate(vecs):
                    pairs = np.frombuffer(vec.as_py(), "<u4").astype(np.int64)
                    tf = pairs[1::2]
                    table[i] = (1_000_000_000 * tf // (1000 * tf + 12 * ms[i])) @ w[pairs[::2]]
                rows, items = np.nonzero((table >= floor) & (table > 0))
                for i, j in zip(rows.tolist(), items.tolist()):
                    members = ids[i].as_py()
                    kept[j].append((-int(table[i, j]), _order(members[0]), members))
                for j in set(items.tolist()):
                    kept[j] = nsmallest(top, kept[j], key=lambda c: c[:2])
                    if len(kept[j]) == top:
                        floor[j] = -kept[j][-1][0]
        out = [(j, d, -minus) for j, found_ in enumerate(kept)
               for minus, _, d in nsmallest(top, ((minus, _order(d), d) for minus, _, members in found_ for d in members),
                                            key=lambda c: c[:2])]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)],
                                         ["item", "id", "score"])

    return found.mapInArrow(score, "item long, id long, score long")


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Blocks of (row number, id, term counts), bounded by items and by distinct terms."""
    block, held = [], set()
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).toLocalIterator()
    for row in rows:
        counts = Counter()
        for found in terms(bytes(row.text) if row.text is not None else None):
            counts.update(found)
        if block and (len(block) == ITEM_BLOCK or len(held | counts.keys()) > BLOCK_TERMS):
            yield block
            block, held = [], set()
        block.append((row.id, counts))
        held |= counts.keys()
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): per item its ``top`` best documents with a score above 0.

    A term is a run of digits, letters a-z and characters beyond ASCII, only
    A-Z lower-cased. Scores are 64-bit integers by the formulas of
    :func:`weight` and :func:`best`; equal scores rank by ascending document
    id. Defined edge cases: null texts have no terms; an item without terms,
    or whose terms no document holds, gets no rows; items repeating an id are
    ranked one by one; documents repeating an id are ranked as rows of their
    own; null document ids come last; a very long text is cut in blocks
    between terms; empty tables give an empty result; other columns are not
    read.
    """
    spark = docs.sparkSession
    id_type = items.schema[item_id].dataType
    ranked = spark.createDataFrame([], T.StructType([
        T.StructField(item_id, id_type), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    totals = None
    for block in _item_blocks(items, item_id, item_text):
        vocabulary = sorted(set().union(*(c for _, c in block)))
        if not vocabulary:
            continue
        found = materialize(vectors(docs, vocabulary, id_col, text_col), "search-vectors")
        if totals is None:
            totals = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"),
                               F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        if not totals.docs:
            return ranked
        df = document_frequency(found, len(vocabulary))
        number = {t: i for i, t in enumerate(vocabulary)}
        table = np.zeros((len(vocabulary), len(block)), np.int64)
        for j, (_, counts) in enumerate(block):
            for t, n in counts.items():
                table[number[t], j] = n * weight(totals.docs, int(df[number[t]]))
        scored = best(classes(found, totals.docs, totals.length, top), table, top)
        place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(block)], T.StructType([
            T.StructField("item", T.LongType()), T.StructField("name", id_type)]))
        # one row per item of the block: at most ITEM_BLOCK
        out = (scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
               .join(F.broadcast(names), "item")
               .select(F.col("name").alias(item_id), "rank", F.col("id").alias("doc_id"), "score"))
        ranked = ranked.unionByName(out)
    return ranked
