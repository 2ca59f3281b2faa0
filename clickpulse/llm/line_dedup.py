"""Line deduplication by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. A line goes if an earlier line (in order of
document id, then line number) has Jaccard similarity of 0.8 or more with it.

Equal lines are collapsed first. The words of a set are ordered from rare to
frequent; two similar sets must share a word within their prefixes, the
smaller one within the shorter prefix that also serves sets of its own size,
so the prefixes are joined by word under length and positional filters and
the candidates are verified on the words themselves. Before that, every set
is verified against the earliest set of each word of its shorter prefix; the
sets which that decides ask no more, so a large group of near copies does not
meet pair by pair.

The job runs in steps, each written to the shared folder; the shuffle files
of a step go when it ends, and no plan holds the steps before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from clickpulse.llm.common import WHITE, materialize, shielded, short_shuffles, without

#: Similarity threshold P / Q.
P, Q = 4, 5
#: Words are counted in this many hash buckets as a power of two (a table of eight bytes each, sent to every
#: task); the counts only order the words, any order is correct.
_BUCKET_BITS = 18
_CLASSES = 62
#: The lists of removed lines are sent to every task up to this size.
BROADCAST_BYTES = 64 << 20
#: So are the numbers of the sets to verify, as many as this; more are shuffled to meet the sets.
BROADCAST_SETS = 1 << 20
#: Sets of this many words have 128 parity bits instead of 64, which say little about them.
_LONG = 60
_BREAK = "\n"
#: Distinct lines and random numbers fill a dictionary for nothing; the level trades a little disk for time.
_PLAIN = {"parquet.enable.dictionary": "false", "parquet.compression.codec.zstd.level": "1"}


def _spaced(text: Column) -> Column:
    """``text``, a line that has words, with its words one space apart and nothing around them."""
    odd = F.lit(False)
    for gap in ("\t", "\x0b", "\x0c", "\r", "  "):
        odd = odd | F.contains(text, F.lit(gap))
    odd = odd | F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    return F.when(odd, F.btrim(F.regexp_replace(text, WHITE, " "), F.lit(" "))).otherwise(text)


def _words(line: Column) -> Column:
    """Words of a ``_spaced`` line, repeats included."""
    return F.split(line, " ")


def _hashes(line: Column) -> Column:
    """The different words of a ``_spaced`` line as 64-bit hashes."""
    return F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)))


def rarity_table(sets: DataFrame) -> tuple[DataFrame, int]:
    """One row: for every bucket of word hashes, by the top bits, what turns them into its frequency class.

    Counted over the words ``h`` of all sets. Also the class from which on are half of all words.
    """
    word = sets.select(F.explode("h").alias("h"))
    at = F.shiftrightunsigned("h", 64 - _BUCKET_BITS)
    # four buckets a row: a quarter of the rows to look up, and to shuffle
    counts = (word.groupBy(F.shiftrightunsigned(at, 2).cast("int").alias("row"))
              .agg(*(F.count(F.when(at.bitwiseAND(3) == j, 1)).alias(f"n{j}") for j in range(4))).toArrow())
    n = np.zeros((1 << _BUCKET_BITS - 2, 4))
    n[counts.column("row").to_numpy()] = np.stack([counts.column(f"n{j}").to_numpy() for j in range(4)], axis=1)
    n = n.ravel()
    top = math.log2(max(2.0, n.max()))
    rank = np.minimum(_CLASSES, np.log2(1 + n) / top * _CLASSES).astype(np.int64)
    above = np.arange(len(n)) >> (_BUCKET_BITS - 7)
    table = sets.sparkSession.createDataFrame(pa.table({"turn": pa.array([(rank ^ above) << 57])}))
    below = np.cumsum(np.bincount(rank, weights=n, minlength=_CLASSES + 1))
    return table, int(np.searchsorted(below, below[-1] / 2)) + 1


def _keys(sets: DataFrame, rarity: DataFrame) -> DataFrame:
    """``sets`` with its words ``k`` as numbers in the order rare to frequent, and their count ``n``.

    A key is the frequency class above the low 57 bits of the word's hash.
    """
    # one step a word and never null, so that Spark sorts plain numbers
    key = lambda h: F.coalesce(h.bitwiseXOR(F.get(
        F.col("__table"), F.shiftrightunsigned(h, 64 - _BUCKET_BITS).cast("int"))), F.lit(0))
    return (sets.withColumn("__table", rarity.scalar())
            .withColumn("k", F.sort_array(F.transform("h", key))).drop("__table")
            .withColumn("n", F.coalesce(F.size("k"), F.lit(0))))


def _alike(a: str, b: str) -> Column:
    """Length, positional and parity filter of two prefix words, for rows ``a`` and ``b`` with n, i, x, y.

    ``x`` has bit j set if an odd number of the set's words fall on j: two
    sets differ in at least as many words as their ``x`` differ in bits. Long
    sets have their frequent words in ``y`` instead, so ``x ^ y`` is of all.
    """
    need = f"((({a}n + {b}n) * {P} + {P + Q - 1}) div {P + Q})"
    bits = (f"CASE WHEN least({a}n, {b}n) >= {_LONG} THEN bit_count({a}x ^ {b}x) + bit_count({a}y ^ {b}y) "
            f"ELSE bit_count({a}x ^ {a}y ^ {b}x ^ {b}y) END")
    return F.expr(f"{Q} * least({a}n, {b}n) >= {P} * greatest({a}n, {b}n) "
                  f"AND least({a}n - {a}i, {b}n - {b}i) >= {need} "
                  f"AND {bits} <= {a}n + {b}n - 2 * {need}")


def _parity(words: Column) -> Column:
    """64 bits, word ``k`` flips bit k & 63; never null, so that a join has no filter."""
    return F.coalesce(F.aggregate(words, F.lit(0).cast("bigint"), lambda x, k: x.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), k.bitwiseAND(63).cast("int")))), F.lit(0))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, line_no, line, s, s2): the lines that have words; s and s2 are independent hashes."""
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"),
                        F.posexplode(F.split(F.col(text_col), _BREAK)).alias("line_no", "line"))
            .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("s", F.xxhash64("line")).withColumn("s2", F.xxhash64(F.lit(5), "line")))


def _place(prefix: str = "") -> Column:
    """Sortable place of a line: null ids last, then id, text hash (repeated ids) and number."""
    c = lambda n: F.col(prefix + n)
    return F.struct(c("id").isNull().alias("no_id"), c("id").alias("id"), c("hash").alias("hash"),
                    c("line_no").alias("line_no"))


def _named(sets: DataFrame, few: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``sets`` whose ``s`` is in the written table ``few``; with "left" all rows, with the columns of both."""
    return sets.join(F.broadcast(few) if few.count() <= BROADCAST_SETS else few, "s", how)


def _entries(keyed: DataFrame, words: Column) -> DataFrame:
    """(w, s, o, x, y, n, i, asks), dealt by ``w``: a row for each of the ``words``, i counts them from 0."""
    # numbers that cannot be null leave a join nothing to filter before the exchange
    rows = (keyed.select("s", "o", "x", "y", "n", "asks", F.posexplode(words).alias("i", "w"))
            .select(*(F.coalesce(c, F.lit(0)).alias(c) for c in ("w", "s", "o", "x", "y")), F.expr(
                "coalesce(shiftleft(cast(n as bigint), 32) | shiftleft(cast(i as bigint), 1) | asks, 0)").alias("nia"))
            .repartition("w"))
    return rows.select("w", "s", "o", "x", "y", F.expr("shiftrightunsigned(nia, 32)").alias("n"),
                       F.expr("shiftrightunsigned(nia, 1) & 2147483647").alias("i"), F.expr("nia & 1").alias("asks"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(s): the later sets of the pairs (a, b) whose Jaccard similarity reaches P / Q."""
    # few rows and a partition count of its own, else Spark drops the exchange and finds the sets anew for every use
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4 + 1
    asked = (_named(sets, materialize(pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct(), "named-sets"))
             .select("s", "place", "line").repartition(parts, "s"))
    one = pairs.join(asked.select(F.col("s").alias("a"), F.col("place").alias("pa"), F.col("line").alias("la")), "a")
    two = one.join(asked.select(F.col("s").alias("b"), F.col("place").alias("pb"), F.col("line").alias("lb")), "b")
    # the words are bound in a lambda: named twice in a plain filter, they would be cut twice
    words = F.array(F.struct(F.array_distinct(_words(F.col("la"))).alias("a"),
                             F.array_distinct(_words(F.col("lb"))).alias("b")))
    alike = F.exists(words, lambda w: (P + Q) * F.size(F.array_intersect(w["a"], w["b"]))
                     >= P * (F.size(w["a"]) + F.size(w["b"])))
    return two.where(alike).select(F.when(F.col("pa") > F.col("pb"), F.col("a")).otherwise(F.col("b")).alias("s"))


def similar_later(sets: DataFrame) -> DataFrame:
    """(s): the sets for which an earlier similar set exists; ``sets`` is (s, place, line), one row per line."""
    place_id = F.col("place.id")
    # integer ids order the lines already in the joins; other ids leave that to the verification
    integral = isinstance(sets.schema["place"].dataType["id"].dataType, IntegralType)
    order = F.coalesce(place_id.cast("bigint"), F.lit((1 << 63) - 1)) if integral else F.lit(0).cast("bigint")
    prefix = F.slice("k", F.lit(1), F.expr(f"n - (({P} * n + {Q - 1}) div {Q}) + 1"))
    # 31 bits of a word are enough to meet: a chance meeting only adds a candidate
    word = F.transform(prefix, lambda k: k.bitwiseAND(2147483647).cast("int"))
    # the words are cut and hashed once, for their counts and for the keys
    hashed = sets.select("s", order.alias("o"), _hashes(F.col("line")).alias("h")).persist(StorageLevel.DISK_ONLY)
    try:
        rarity, middle = rarity_table(hashed)
        # the keys are sorted: the frequent words follow where the first key of their class would stand
        is_long, bound = F.col("n") >= _LONG, F.lit(middle << 57)
        rarer = F.when(is_long, F.array_position(F.sort_array(F.array_append("k", bound)), bound).cast("int") - 1)
        x = _parity(F.when(is_long, F.slice("k", F.lit(1), F.col("rarer"))).otherwise(F.col("k")))
        y = F.when(is_long, _parity(F.slice("k", F.col("rarer") + 1, F.col("n")))).otherwise(F.lit(0))
        keyed = materialize(_keys(hashed, rarity).withColumn("rarer", rarer).select(
            "s", "o", "n", x.alias("x"), y.alias("y"), word.alias("words")), "keyed-sets", **_PLAIN)
    finally:
        hashed.unpersist()

    # of two similar sets the smaller one has the first common word among its first n (Q - P) / (Q + P) + 1 words, and
    # so has each of two sets of one size: these words have leaders
    led = (_entries(keyed.withColumn("asks", F.lit(1)), F.expr(f"slice(words, 1, {Q - P} * n div {P + Q} + 1)"))
           .withColumn("l", F.min(F.struct("o", "s", "n", "i", "x", "y")).over(Window.partitionBy("w"))))
    to_leader = materialize(led.where("s <> l.s").where(_alike("", "l."))
                            .select(F.col("s").alias("a"), F.col("l.s").alias("b")).distinct(), "leader-pairs")
    decided = materialize(_verified(to_leader, sets).distinct(), "decided-sets")

    known = decided.withColumn("asks", F.lit(0))
    entries = _entries(_named(keyed, known, "left").withColumn("asks", F.coalesce("asks", F.lit(1))), F.col("words"))
    # the row number, always positive, keeps the filter behind the exchange, so that both sides of the join share it
    near = entries.where(F.when(F.monotonically_increasing_id() >= 0, F.expr(f"{P + Q} * i <= {Q - P} * n")))
    x, y = entries.alias("x"), near.alias("y")
    pairs = (x.join(y, F.expr(f"x.w = y.w AND y.n <= x.n AND {Q} * y.n >= {P} * x.n AND (y.n < x.n OR y.s < x.s) "
                              # the later one asks
                              "AND (x.asks = 1 AND x.o >= y.o OR y.asks = 1 AND y.o >= x.o)") & _alike("x.", "y."))
             .select(F.least("x.s", "y.s").alias("a"), F.greatest("x.s", "y.s").alias("b")).distinct())
    pairs = materialize(pairs, "line-pairs")
    return decided.unionByName(_verified(pairs, sets)).distinct()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash, removed): the sorted numbers (from 0) of the lines that go, per text that loses any."""
    lines = _lines(docs, id_col, text_col)
    sets = materialize(lines.groupBy("s").agg(F.min(F.struct(_place().alias("place"), "s2", "line")).alias("f"),
                                              F.count(F.lit(1)).alias("times"))
                       .select("s", "f.place", "f.s2", _spaced(F.col("f.line")).alias("line"), "times"),
                       "line-sets", "zstd", **_PLAIN)
    gone = materialize(similar_later(sets.select("s", "place", "line")), "gone-sets").withColumn("gone", F.lit(True))
    # lines that occur once and stay are left out from here on
    verdict = materialize(_named(sets.select("s", "place", "s2", "times"), gone, "left").where("gone OR times > 1")
                          .select("s", F.col("place").alias("first"), F.col("s2").alias("v2"), "gone"), "verdict")
    lines = _named(lines.select("id", "hash", "line_no", "s", "s2"), verdict.select("s"))
    # a line whose second hash differs only shares the first by chance: it stays
    # (compared by bits, so that the sets meet the lines where they are, by the first hash)
    out = (lines.join(verdict.withColumnRenamed("s", "vs"),
                      (F.col("s") == F.col("vs")) & (F.col("s2").bitwiseXOR(F.col("v2")) == 0))
           .where((_place() != F.col("first")) | F.col("gone")))
    return out.groupBy("id", "hash").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


@shielded
def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs``, its text without the removed lines, plus ``n_lines, removed_lines``.

    Lines are cut at line feeds; words are runs of anything but ASCII white
    space. Lines without words stay. Defined edge cases: a null text stays
    null (0 lines); an empty text has one line and stays; rows with equal id
    and text are one document and lose the same lines; null ids come last; a
    text may become empty, its row stays; an empty table gives an empty
    result; input columns named like an output column are replaced.
    """
    docs = without(docs, "n_lines", "removed_lines")
    with short_shuffles(docs.sparkSession):
        gone = materialize(removed_lines(docs.select(id_col, text_col), id_col, text_col), "removed-lines")
        size = gone.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("removed")).alias("lines")).first()
    if 40 * size.rows + 4 * (size.lines or 0) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)        # else the texts are shuffled to meet their lists
    hashed = (docs.withColumn("__hash", F.xxhash64(text_col))
              .withColumn("__n", F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, _BREAK)))))
    met = hashed.alias("d").join(gone.alias("g"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("g.id"))
                                 & (F.col("d.__hash") == F.col("g.hash")), "left")
    text, removed = F.col(f"d.`{text_col}`"), F.col("g.removed")
    lines = F.split(text, _BREAK)
    # the stretches between removed lines, so that long texts take linear time
    before = lambda k: F.when(k == 0, -1).otherwise(F.element_at(removed, k))
    after = lambda k: F.when(k == F.size(removed), F.size(lines)).otherwise(F.element_at(removed, k + 1))
    kept = F.array_join(F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(removed)),
        lambda k: F.slice(lines, before(k) + 2, after(k) - before(k) - 1))), _BREAK)
    out = [F.when(removed.isNull(), text).otherwise(kept).alias(c) if c == text_col else F.col(f"d.`{c}`")
           for c in docs.columns]
    return met.select(*out, F.col("d.__n").cast("bigint").alias("n_lines"),
                      F.coalesce(removed, F.array().cast("array<int>")).alias("removed_lines"))
