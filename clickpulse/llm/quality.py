"""Quality classification by a generalised additive model with pairwise interactions.

A text becomes a short vector of shape features. Each feature is cut into
bins; boosting visits the features in turn (cyclic), fits a tree of at most
four leaves on that feature's bins to the current residuals and adds it to
the feature's lookup table. Then the pairs of features with the largest
residual gain get tables of their own, learned in the same way by trees that
cut both features. A score is the sum of the looked-up table entries.

Features come from whole texts, read in blocks: word windows and character
counts, so that a long text needs no more memory than a block.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from clickpulse.llm.common import shielded, without

#: Bounded sample of labelled rows: this many of each class, those with the smallest hash of the id.
CLASS_ROWS = 4000
#: Characters read at once, and words per window of the repetition features.
BLOCK_CHARS = 1 << 16
WINDOW_WORDS = 256
#: Bins of a feature alone and of a feature in a pair; leaves a tree needs at least this much hessian.
BINS, PAIR_BINS = 64, 16
PAIRS = 8
ROUNDS, PAIR_ROUNDS = 120, 60
RATE, RIDGE, MIN_HESSIAN = 0.1, 1.0, 2.0

FEATURES = ("log_chars", "log_words", "word_length", "upper", "digit", "symbol", "sentence_end", "exclaim", "white",
            "line_breaks", "non_ascii", "distinct_words", "top_word", "repeated_next", "upper_words",
            "marked_words", "letterless_words", "compressed")

_END, _EXCLAIM, _SYMBOL, _UPPER, _DIGIT, _WHITE, _BREAK, _LETTER = (1 << i for i in range(8))
_PLAIN_MARKS = ".,;:!?'\"()-"


def _classes() -> np.ndarray:
    """Class bits of every code point of the basic plane."""
    table = np.zeros(1 << 16, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isspace():
            table[i] = _WHITE | (_BREAK if c == "\n" else 0)
        elif c.isalpha():
            table[i] = _LETTER | (_UPPER if c.isupper() else 0)
        elif c.isdigit():
            table[i] = _DIGIT
        elif c not in _PLAIN_MARKS:
            table[i] = _SYMBOL
        else:
            table[i] = (_END if c in ".!?" else 0) | (_EXCLAIM if c == "!" else 0)
    return table


_TABLE = _classes()


def _blocks(text: str) -> Iterator[str]:
    """Consecutive parts of about ``BLOCK_CHARS`` characters, cut at a space where there is one."""
    at = 0
    while at < len(text):
        end = at + BLOCK_CHARS
        if end < len(text):
            gap = max(text.rfind(" ", at + BLOCK_CHARS // 2, end), text.rfind("\n", at + BLOCK_CHARS // 2, end))
            end = gap + 1 if gap > 0 else end
        yield text[at:end]
        at = end


def features(text: str | None) -> np.ndarray:
    """The feature vector (``FEATURES``) of a whole text; null and empty texts give zeros."""
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    counts = np.zeros(256, np.int64)
    wide = words = 0
    distinct = top = again = upper = marked = letterless = 0
    packer, packed, size = zlib.compressobj(1), 0, 0
    for block in _blocks(text):
        raw = block.encode("utf-8", "surrogatepass")
        size += len(raw)
        packed += len(packer.compress(raw))
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), np.uint32)
        # beyond the basic plane (below 0.1 % of ordinary text) characters count as letters
        kind = np.where(codes < 1 << 16, _TABLE[codes & 0xFFFF], _LETTER)
        counts += np.bincount(kind, minlength=256)
        wide += int((codes > 127).sum())
        ink = np.concatenate([[False], (kind & _WHITE) == 0, [False]])
        start, stop = np.flatnonzero(ink[1:] & ~ink[:-1]), np.flatnonzero(ink[:-1] & ~ink[1:])
        start = start[:len(stop)]
        if len(start):
            letters = np.add.reduceat((kind & _LETTER) > 0, start, dtype=np.int32)
            capitals = np.add.reduceat((kind & _UPPER) > 0, start, dtype=np.int32)
            words += len(start)
            upper += int(((capitals == letters) & (letters > 1)).sum())
            letterless += int((letters == 0).sum())
            marked += int(((kind[stop - 1] & _SYMBOL) > 0).sum())
        found = block.split()
        again += sum(map(str.__eq__, found, found[1:]))
        distinct += sum(len(set(found[i:i + WINDOW_WORDS])) for i in range(0, len(found), WINDOW_WORDS))
        top += max(Counter(found).values(), default=0)
    packed += len(packer.flush())
    chars = len(text)
    of = lambda bit: counts[(np.arange(256) & bit) > 0].sum() / chars
    w = max(1, words)
    out[:] = (np.log1p(chars), np.log1p(words), (chars - counts[(np.arange(256) & _WHITE) > 0].sum()) / w, of(_UPPER), of(_DIGIT), of(_SYMBOL), of(_END),
              of(_EXCLAIM), of(_WHITE), of(_BREAK), wide / chars, distinct / w, top / w, again / w, upper / w,
              marked / w, letterless / w, packed / size)
    return out


@dataclass(frozen=True)
class Model:
    """Cut points and lookup tables: one table per feature, one per chosen pair of features."""

    base: float
    cuts: tuple
    tables: tuple
    pair_cuts: tuple
    pairs: tuple
    pair_tables: tuple


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="lower"))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, position) of the cut of a histogram that lowers the loss most; position 0: none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN), _gain(gl, hl) + _gain(gr, hr) - _gain(g.sum(), h.sum()), 0)
    at = int(gain.argmax())
    return (float(gain[at]), at + 1) if gain[at] > 0 else (0.0, 0)


def _step(g, h) -> float:
    return RATE * g.sum() / (h.sum() + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree of ``depth`` cuts along one feature."""
    at = _best_cut(g, h)[1] if depth else 0
    if not at:
        return np.full(len(g), _step(g, h))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values per cell) of the tree that cuts one feature of a pair, then the other in each half."""
    best_gain, best = 0.0, np.full(g.shape, _step(g, h))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        first = _best_cut(a.sum(1), b.sum(1))[1] or len(a) // 2
        total, values = 0.0, np.empty(a.shape)
        for half in (slice(0, first), slice(first, len(a))):
            ga, hb = a[half].sum(0), b[half].sum(0)
            gain, at = _best_cut(ga, hb)
            total += gain + _gain(ga.sum(), hb.sum())
            for part in ((slice(0, at), slice(at, None)) if at else (slice(None),)):
                values[half, part] = _step(ga[part], hb[part])
        total -= _gain(g.sum(), h.sum())
        if total > best_gain:
            best_gain, best = total, values.T if flip else values
    return best_gain, best


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, share: float) -> Model | None:
    """Fit on feature rows ``x`` with labels ``y``; ``share`` is class 1's part of all labelled rows.

    The classes are weighted to ``share``, so that scores are probabilities
    of the table, not of the sample. None if a class has no rows.
    """
    ones = int(y.sum())
    if not 0 < ones < len(y):
        return None
    share = min(max(share, 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, share / ones, (1 - share) / (len(y) - ones)) * len(y)
    base = float(np.log(share / (1 - share)))
    z = np.full(len(y), base)
    k = x.shape[1]

    def pulls():
        p = _sigmoid(z)
        return weight * (y - p), weight * p * (1 - p)

    cuts = [_cuts(x[:, f], BINS) for f in range(k)]
    bins = [np.searchsorted(cuts[f], x[:, f], "left") for f in range(k)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    for _ in range(ROUNDS):
        for f in range(k):
            g, h = pulls()
            add = _tree(np.bincount(bins[f], g, len(tables[f])), np.bincount(bins[f], h, len(tables[f])))
            tables[f] += add
            z += add[bins[f]]

    pair_cuts = [_cuts(x[:, f], PAIR_BINS) for f in range(k)]
    coarse = [np.searchsorted(pair_cuts[f], x[:, f], "left") for f in range(k)]
    width = [len(c) + 1 for c in pair_cuts]
    cell = lambda a, b: coarse[a] * width[b] + coarse[b]
    grid = lambda a, b, v: np.bincount(cell(a, b), v, width[a] * width[b]).reshape(width[a], width[b])
    g, h = pulls()
    ranked = sorted(((_pair_tree(grid(a, b, g), grid(a, b, h))[0], a, b) for a, b in combinations(range(k), 2)),
                    key=lambda t: (-t[0], t[1], t[2]))
    pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((width[a], width[b])) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for table, (a, b) in zip(pair_tables, pairs):
            g, h = pulls()
            add = _pair_tree(grid(a, b, g), grid(a, b, h))[1]
            table += add
            z += add.ravel()[cell(a, b)]
    return Model(base, tuple(cuts), tuple(tables), tuple(pair_cuts), tuple(pairs), tuple(pair_tables))


def scores(m: Model, x: np.ndarray) -> np.ndarray:
    """Probabilities of class 1 for feature rows ``x``: sums of table entries."""
    z = np.full(len(x), m.base)
    for f, (cuts, table) in enumerate(zip(m.cuts, m.tables)):
        z += table[np.searchsorted(cuts, x[:, f], "left")]
    for (a, b), table in zip(m.pairs, m.pair_tables):
        z += table[np.searchsorted(m.pair_cuts[a], x[:, a], "left"), np.searchsorted(m.pair_cuts[b], x[:, b], "left")]
    return _sigmoid(z)


@F.arrow_udf(ArrayType(DoubleType()))
def _features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([features(t.as_py()).tolist() for t in texts], pa.list_(pa.float64()))


def train_on(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> Model | None:
    """Fit on at most ``CLASS_ROWS`` labelled rows of each class, those with the smallest hash of the id.

    ``learn`` is a condition on ``id_col`` that keeps held-out rows away. The
    ids are chosen from the labels alone; features are computed where the
    texts are, only feature rows reach the driver. Null labels and ids are
    skipped; an id labelled both ways counts as 0; of rows repeating an id one
    text is taken; null texts count as empty.
    """
    flag = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(learn)
            .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("y")))
    sizes = {r.y: r.n for r in flag.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}

    def first(y: int) -> DataFrame:
        return flag.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(CLASS_ROWS)

    # at most 2 x CLASS_ROWS ids: small enough for every task
    chosen = F.broadcast(first(0).unionByName(first(1)))
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(chosen, "id").select("id", "y", _features("text").alias("x"))
            .groupBy("id", "y").agg(F.min("x").alias("x")).orderBy("id").select("x", "y").toArrow())
    if not rows.num_rows:
        return None
    x = np.array(rows.column("x").to_pylist(), float).reshape(rows.num_rows, len(FEATURES))
    return train(x, rows.column("y").to_numpy().astype(float), sizes.get(1, 0) / max(1, sum(sizes.values())))


@shielded
def quality(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Every row of ``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are read. Defined edge cases: null and empty texts score the
    zero vector; a very long text is read in blocks of ``BLOCK_CHARS`` (a
    longer word counts in parts); equal texts get equal scores; an empty table
    gives an empty result; without a model (a class had no rows) every score
    is 0.5; input columns named like an output column are replaced.
    """
    docs = without(docs, "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            if m is None or not len(texts):
                yield pa.array([0.5] * len(texts), pa.float64())
            else:
                yield pa.array(scores(m, np.stack([features(t.as_py()) for t in texts])), pa.float64())

    return (docs.withColumn("score", scored(F.coalesce(F.col(text_col), F.lit(""))))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
