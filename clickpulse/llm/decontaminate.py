"""Benchmark decontamination: rare n-grams as seeds, then Smith-Waterman alignment.

The n-grams are pairs of words with at most one edit between them: one or two
places apart in the item, one or two in the text. An alignment of M matched
words and E edits scores 2 M - E; if that is at least 2 t m (share t of an item
of m words), then E / 2 <= M - t m. At most E / 2 of the M - 1 steps from a
matched word to the next have two edits or more, so at least t m - 1 steps are
such pairs, each from another position of the item. The pairs of all items are
counted over all training texts, and just enough positions with the rarest
pairs become seeds that one of them is sure to be met: no passage that reaches
the threshold is missed, however it is edited. Items too short for a sure pair
are sought by their words. Seeds join passages of the training texts to items;
passages that two upper bounds of the score leave over are aligned with the
item word by word and scored against its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from clickpulse.llm.common import shielded, without

#: Alignment scores; an item's own score is MATCH times its words. The seeds
#: rest on a match being worth two edits.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of the item's own score from which a passage is contaminated.
THRESHOLD = 0.5
#: Items are sent to the tasks in blocks of at most this many characters; a
#: larger test set takes one pass over the texts per block.
BLOCK_CHARS = 16 << 20
_GAP = re.compile(r"[^\w\s]+")          # with white space, what stands between words


def words(text: str | None) -> list[str]:
    """The ``\\w+`` of the lower-cased text: cut at white space once the rest is white space, the faster way."""
    return _GAP.sub(" ", text.lower()).split() if text else []


@dataclass
class Items:
    """A block of test items with their words as numbers (0: no word of any item)."""
    ids: list
    vocab: dict[str, int]
    texts: list[np.ndarray]
    #: The distinct words of each text and how often it has them.
    bags: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        vocab: dict[str, int] = {}
        ids, texts = [], []
        for item, text in rows:
            found = [vocab.setdefault(w, len(vocab) + 1) for w in words(text)]
            if found:
                ids.append(item)
                texts.append(np.array(found, np.int64))
        return cls(ids, vocab, texts, [np.unique(a, return_counts=True) for a in texts])

    def numbers(self, text: str | None) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.vocab.get, found, repeat(0)), np.int64, len(found))


class Grams:
    """Numbered n-grams: pairs of words, and single words (a pair with 0)."""

    def __init__(self, keys: np.ndarray, base: int):
        self.keys, self.base = np.unique(keys), base
        first, second = np.divmod(self.keys, base)
        self.alone, self.starts, self.ends = np.zeros((3, base), bool)
        self.alone[first[second == 0]] = True
        self.starts[first[second > 0]] = True
        self.ends[second[second > 0]] = True

    def find(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, place of the first word) of every n-gram in a text, pairs one or two places apart."""
        places = [np.flatnonzero(self.alone[a])]
        keys = [a[places[0]] * self.base]
        for step in (1, 2):
            at = np.flatnonzero(self.starts[a[:-step]] & self.ends[a[step:]])
            places.append(at)
            keys.append(a[at] * self.base + a[at + step])
        key, place = np.concatenate(keys), np.concatenate(places)
        number = np.searchsorted(self.keys, key)
        held = np.flatnonzero(number < len(self.keys))
        held = held[self.keys[number[held]] == key[held]]
        return number[held], place[held]


@dataclass
class Seeds:
    """Seeds of n-gram g: item ``item[k]`` at position ``at[k]`` for k in ``first[g]:first[g + 1]``."""
    grams: Grams
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray

    def hits(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, position in the text minus position in the item) of every seed in the text, by item."""
        gram, where = self.grams.find(a)
        size = self.first[gram + 1] - self.first[gram]
        k = np.repeat(self.first[gram] - np.cumsum(size) + size, size) + np.arange(size.sum())
        item, diagonal = self.item[k], np.repeat(where, size) - self.at[k]
        order = np.lexsort((diagonal, item))
        return item[order], diagonal[order]


def item_grams(items: Items, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, item, position, how many positions of the item are seeds) of every n-gram an item can be sought by."""
    base = len(items.vocab) + 1
    found = [np.zeros((4, 0), np.int64)]
    for k, a in enumerate(items.texts):
        m = len(a)
        sure = math.ceil(threshold * m - 1e-9) - 1
        if sure < 1:
            parts = [(a * base, np.arange(m), m)]
        else:               # of m - 1 first positions, so many that fewer than ``sure`` are left
            parts = [(a[:-step] * base + a[step:], np.arange(m - step), m - sure) for step in (1, 2)]
        found += [np.stack([key, np.full(len(at), k), at, np.full(len(at), n)]) for key, at, n in parts]
    return tuple(np.concatenate(found, axis=1))


def count_grams(texts: DataFrame, items: Items, grams: Grams) -> np.ndarray:
    """Number of training texts that hold each n-gram; at most one number per n-gram comes back."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(grams.keys), np.int64)
        for b in batches:
            for t in b.column(0):
                held[np.unique(grams.find(items.numbers(t.as_py()))[0])] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"g": pa.array(at, pa.int64()), "n": pa.array(held[at], pa.int64())})

    rows = texts.mapInArrow(count, "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(grams.keys), np.int64)
    counts[rows.column("g").to_numpy()] = rows.column("n").to_numpy()
    return counts


def choose_seeds(texts: DataFrame, items: Items, threshold: float) -> Seeds:
    """The n-grams at the rarest positions of every item, as many as no passage at the threshold can miss.

    A position is as frequent as its n-grams together. N-grams that no
    training text holds take part in the choice but need no seed.
    """
    key, item, at, most = item_grams(items, threshold)
    grams = Grams(key, len(items.vocab) + 1)
    counts = count_grams(texts, items, grams)[np.searchsorted(grams.keys, key)]
    places, of = np.unique(item * (at.max() + 1) + at, return_inverse=True)
    weight, owner = np.bincount(of, weights=counts), places // (at.max() + 1)
    order = np.lexsort((weight, owner))                         # an item's positions, rarest first
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order)) - np.searchsorted(owner, owner)
    seed = np.flatnonzero((rank[of] < most) & (counts > 0))
    seed = seed[np.argsort(key[seed], kind="stable")]
    chosen = Grams(key[seed], len(items.vocab) + 1)
    return Seeds(chosen, np.searchsorted(key[seed], np.append(chosen.keys, np.iinfo(np.int64).max)),
                 item[seed], at[seed])


def bound(gains: np.ndarray) -> int:
    """No alignment scores more if words of the item gain MATCH and each other word inside costs."""
    sums = gains.cumsum(dtype=np.int64)
    return int((sums - np.minimum(np.minimum.accumulate(sums), 0)).max(initial=0))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, position of its last word in ``passage``, in ``item``), linear gaps."""
    ramp = -GAP * np.arange(len(passage) + 1)
    prev = np.zeros(len(passage) + 1, np.int64)
    best, at, row = 0, -1, -1
    for i, w in enumerate(item):
        cur = np.zeros(len(passage) + 1, np.int64)
        cur[1:] = np.maximum(0, np.maximum(prev[:-1] + np.where(passage == w, MATCH, MISMATCH), prev[1:] + GAP))
        cur = np.maximum.accumulate(cur + ramp) - ramp      # gaps along the passage
        top = int(cur.argmax())
        if cur[top] > best:
            best, at, row = int(cur[top]), top - 1, i
        prev = cur
    return best, at, row


class Scratch:
    """Per word number: the text's count of it (0), what it adds to ``bound`` (the cost); reset after use."""

    def __init__(self, items: Items):
        self.have = np.zeros(len(items.vocab) + 1, np.int64)
        self.gain = np.full(len(items.vocab) + 1, max(MISMATCH, GAP), np.int8)


def _likely(a: np.ndarray, items: Items, near: np.ndarray, threshold: float, scratch: Scratch) -> list[int]:
    """Those items of ``near`` that share enough words with the text, wherever it has them."""
    bags = [items.bags[k] for k in near.tolist()]
    word, have = np.unique(a, return_counts=True)
    scratch.have[word] = have
    wanted, most = np.concatenate([w for w, _ in bags]), np.concatenate([n for _, n in bags])
    both = np.minimum(scratch.have[wanted], most)
    scratch.have[word] = 0
    sizes = np.array([len(w) for w, _ in bags])
    shared = np.add.reduceat(both, sizes.cumsum() - sizes)
    return [k for k, n in zip(near.tolist(), shared.tolist()) if n >= threshold * len(items.texts[k])]


def find_items(a: np.ndarray, items: Items, seeds: Seeds, threshold: float, scratch: Scratch) -> list[tuple]:
    """(item, score, first word, last word) of the contaminated passages, the best one per item."""
    near, diagonals = seeds.hits(a)
    if not len(near):
        return []
    found = []
    for k in _likely(a, items, near[np.r_[True, near[1:] != near[:-1]]], threshold, scratch):
        item, (word, most) = items.texts[k], items.bags[k]
        m = len(item)
        need = threshold * MATCH * m
        scratch.gain[word] = MATCH
        gains = scratch.gain[a]
        scratch.gain[word] = max(MISMATCH, GAP)
        if bound(gains) < need:
            continue
        # gaps cost, so a passage reaches no further from a seed's diagonal
        pad = max(0, math.floor((MATCH * m - need) / -GAP))
        near_k = diagonals[np.searchsorted(near, k):np.searchsorted(near, k, "right")]
        cut = np.flatnonzero(np.diff(near_k) > m + 2 * pad) + 1
        best = None
        for lo, hi in zip(near_k[np.r_[0, cut]] - pad, near_k[np.r_[cut - 1, -1]] + m + pad):
            start = max(0, int(lo))
            part = a[start:hi]
            if bound(gains[start:hi]) < need:
                continue
            # no alignment matches more words than the two have in common
            have = np.bincount(np.searchsorted(word, part[gains[start:hi] == MATCH]), minlength=len(word))
            if np.minimum(have, most).sum() * MATCH < need:
                continue
            s, at, row = align(item, part)
            if s >= need and (best is None or s > best[0]):
                _, back, _ = align(item[:row + 1][::-1], part[:at + 1][::-1])
                best = (s, start + at - back, start + at)
        if best:
            found.append((k, best[0] / (MATCH * m), best[1], best[2]))
    return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[Items]:
    rows = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("length(t) > 0")
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-chars // block_chars)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("t"), F.lit(n)) == k).orderBy("i", "t").collect()
        items = Items.of([(r.i, r.t) for r in part])
        if items.ids:
            yield items


def _matches(docs: DataFrame, items: Items, item_type: str, text_col: str, threshold: float):
    """Column of the contaminated items of each text: array<struct<item_id, score, first_word, last_word>>."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    seeds = choose_seeds(texts, items, threshold)
    shared = docs.sparkSession.sparkContext.broadcast((items, seeds))
    id_kind = _arrow_type(item_type)

    @F.arrow_udf(f"array<struct<item_id:{item_type},score:double,first_word:bigint,last_word:bigint>>")
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items, seeds = shared.value
        scratch = Scratch(items)
        kind = None
        for b in batches:
            out = []
            for t in b:
                hits = find_items(items.numbers(t.as_py()), items, seeds, threshold, scratch)
                out.append([{"item_id": items.ids[k], "score": s, "first_word": x, "last_word": y}
                            for k, s, x, y in hits])
            kind = kind or pa.list_(pa.struct([("item_id", id_kind), ("score", pa.float64()),
                                               ("first_word", pa.int64()), ("last_word", pa.int64())]))
            yield pa.array(out, kind)

    return match(F.coalesce(F.col(text_col), F.lit("")))


def _arrow_type(name: str) -> pa.DataType:
    """The Arrow type of a Spark type's name (on the driver)."""
    return to_arrow_type(_parse_datatype_string(name))


def contaminated_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
                          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item_id, score, first_word, last_word): one row per row of ``docs`` and item found in it.

    ``score`` is the alignment's share of the item's own score, of the best
    passage; the words are counted from 0. Words are ``\\w+`` of the
    lower-cased text. Every item whose best alignment reaches ``threshold``
    (above 0) is found. Null or word-less texts and items match nothing;
    repeated rows and items are answered each; an empty table gives an empty
    result; other columns are not returned.
    """
    item_type = benchmark.schema[item_col].dataType.simpleString()
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, item_id {item_type}, " \
             "score double, first_word bigint, last_word bigint"
    out = None
    for items in _blocks(benchmark, item_col, item_text, block_chars):
        part = (docs.select(id_col, F.explode(_matches(docs, items, item_type, text_col, threshold)).alias("m"))
                .select(id_col, "m.*"))
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


@shielded
def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows in which a test item is found (no shuffle of the texts)."""
    item_type = benchmark.schema[item_col].dataType.simpleString()
    kept = without(docs, "__hits")
    cols = kept.columns
    for items in _blocks(benchmark, item_col, item_text, block_chars):
        kept = (kept.withColumn("__hits", _matches(docs, items, item_type, text_col, threshold))
                .where(F.size("__hits") == 0).select(*cols))
    return kept
