"""Near-duplicates by SimHash with deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints
that differ in at most three bits differ in at most one bit in one of the
segments, so they share that segment's value or one of its 32 variants with
one bit deleted. The variants are an index joined by equality; the Hamming
distance is verified inside the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import materialize, shielded
from clickpulse.llm.components import connected_components

SEED = 42
SEGMENT = 32
#: Bytes of one text hashed at a time; bounds memory for very long texts.
BLOCK = 1 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LANES = np.uint64(0x0101010101010101)


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    start = 0
    while start < len(text):
        gap = _GAP.search(text, start + BLOCK) if len(text) - start > BLOCK else None
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text[start:end])
        start = end


def _shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED)
                     for s, e in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())],
                    dtype=np.uint64)


def _bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of ``h`` have each bit set, eight byte lanes at a time."""
    out = np.zeros((8, 8), dtype=np.int64)          # [byte, bit in byte]
    pad = -len(h) % 255
    rows = np.concatenate((h, np.zeros(pad, np.uint64))).reshape(-1, 255)
    for j in range(8):
        lanes = ((rows >> np.uint64(j)) & _LANES).sum(axis=1, dtype=np.uint64)
        out[:, j] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.reshape(64)


def fingerprint(text: bytes, size: int = 3) -> int:
    """SimHash of the ``size``-word shingles of ``text`` (unsigned 64 bits)."""
    sums, n, tail = np.zeros(64, np.int64), 0, []
    for words in _word_blocks(text.lower()):        # bytes.lower() maps A-Z only
        words = tail + words
        if len(words) >= size:
            h = _shingle_hashes(words, size)
            sums += _bit_sums(h)
            n += len(h)
            tail = words[len(words) - size + 1:] if size > 1 else []
        else:
            tail = words
    if not n:
        if not tail:
            return 0
        sums, n = _bit_sums(np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)), 1
    return int(np.packbits(sums * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(size: int):
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        found = np.fromiter((fingerprint(x.as_py() or b"", size) for x in raw), np.uint64, len(raw))
        return pa.array(found.view(np.int64))
    return simhash


def _segments(fp: str) -> list:
    return [F.col(fp).bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(fp, SEGMENT)]


def _hamming(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _leader_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links to the smallest fingerprint with the same segment value (linear, not all pairs)."""
    keyed = fps.select("fp", F.posexplode(F.array(*_segments("fp"))).alias("s", "value"))
    leaders = keyed.groupBy("s", "value").agg(F.min("fp").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (keyed.join(leaders, ["s", "value"]).where((F.col("fp") != F.col("lead"))
            & (_hamming("fp", "lead") <= max_bits)).select(F.col("fp").alias("a"), F.col("lead").alias("b")))


def _variant_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints of different groups ``g`` that share a segment or a one-wildcard variant.

    Key: segment number, deleted position (32: none) and the segment with
    that bit cleared. A variant pairs only rows whose deleted bit is 0 with
    rows whose bit is 1, so a pair meets once per segment.
    """
    bit = f"cast(s & 1 as bigint) << 38"
    whole = f"({bit}) | (32L << 32) | value"
    per = fps.select("fp", "g", F.posexplode(F.array(*_segments("fp"))).alias("s", "value"))
    cut = per.select("fp", "g", "s", "value", F.explode(F.sequence(F.lit(0), F.lit(SEGMENT - 1))).alias("p"))
    key = f"({bit}) | (cast(p as bigint) << 32) | (value & ~(1L << p))"

    def side(of_bit: int) -> DataFrame:
        return (cut.where(f"((value >> p) & 1) = {of_bit}").selectExpr(f"{key} AS k", "fp", "g", "false AS w")
                .unionByName(per.selectExpr(f"{whole} AS k", "fp", "g", "true AS w")))

    a, b = side(0).alias("a"), side(1).alias("b")
    return (a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.g") != F.col("b.g"))
                   & (~F.col("a.w") | (F.col("a.fp") < F.col("b.fp")))
                   & (_hamming("a.fp", "b.fp") <= max_bits))
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = 3, max_bits: int = 3) -> DataFrame:
    """(id, text_hash, fingerprint, component, component_id) per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` (0 to 3) differing bits, ``component`` a key of the group.
    Equal fingerprints are collapsed first; dense groups are first linked to
    one leader per segment, and the variant join then skips pairs already
    known to be connected, so a group's pairs are not all emitted. Defined
    edge cases: a null text counts as empty; a text without words has
    fingerprint 0 and links like any other; null ids are ignored by the
    minimum (null component_id only if a group has no other id); repeated
    rows all appear; an empty table gives an empty result.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with one wildcard cover at most 3 differing bits")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(F.col(id_col), F.xxhash64(text).alias("text_hash"),
                                   fingerprint_udf(size)(text).alias("fp")), "simhash")
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("rep"))
    first = connected_components(_leader_links(nodes, max_bits), "a", "b")
    grouped = nodes.join(first, nodes.fp == first.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("g"))
    links = _variant_links(grouped, max_bits)
    roots = connected_components(
        links.unionByName(first.select(F.col("node").alias("a"), F.col("root").alias("b"))), "a", "b")
    linked = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("component"))
    ids = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = linked.join(ids, "component").select("fp", "component", "component_id")
    return rows.join(label, "fp").select(
        id_col, "text_hash", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component", "component_id")


@shielded
def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  size: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each SimHash group: the one with the smallest id.

    Ties of the smallest id (repeated rows) are broken by the text's hash and
    then by the hash of all columns; null ids sort last.
    """
    groups = simhash_groups(docs, id_col, text_col, size, max_bits)
    keep = groups.groupBy("component").agg(F.min(F.struct(
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_hash")).alias("k")).select(
        F.col("k.id").alias("__id"), F.col("k.text_hash").alias("__hash"))
    hashed = docs.withColumn("__hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    stay = hashed.alias("d").join(keep.alias("k"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("k.__id"))
                                  & (F.col("d.__hash") == F.col("k.__hash")), "left_semi")
    w = Window.partitionBy(id_col, "__hash").orderBy(F.xxhash64(*docs.columns))
    return stay.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*docs.columns)
