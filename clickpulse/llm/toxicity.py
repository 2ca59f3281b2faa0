"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary
text. Every window of a text is compressed under the ordinary dictionary and
under the toxic one (placed before the same ordinary content, so that the
lengths differ only by what toxic text adds). The bytes saved in the windows
are pooled per document and mapped to a probability by a logistic fit on
labelled rows that no dictionary saw.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import shielded, without

#: Bytes per window (cut at a space) and compression level.
WINDOW = 128
LEVEL = 6
TOXIC_DICT = 4096
ORDINARY_DICT = 112_640
ORDINARY_PARTS = 3
#: Bounded sample of labelled rows: toxic and ordinary ones, and the largest length of one.
TOXIC_ROWS, ORDINARY_ROWS = 2400, 4800
MAX_TRAIN_CHARS = 20_000
WINDOWS_PER_ROW = 8
#: A 5-letter sequence is toxic text if it is this many times as frequent in
#: toxic rows as in ordinary ones, with this much evidence (rows x log ratio).
MIN_RATIO = 12
MIN_EVIDENCE = 30
_WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    mean: tuple
    scale: tuple
    weights: tuple


def windows(text: bytes) -> Iterator[bytes]:
    i, n = 0, len(text)
    while i < n:
        j = i + WINDOW
        if j < n:
            gap = text.rfind(b" ", i + WINDOW // 2, j)
            j = gap if gap > 0 else j
        yield text[i:j]
        i = j


def _compressor(content: bytes):
    d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    p = zstd.ZstdCompressionParameters.from_level(
        LEVEL, source_size=WINDOW, dict_size=len(content), write_content_size=0, write_dict_id=0,
        format=zstd.FORMAT_ZSTD1_MAGICLESS)
    d.precompute_compress(compression_params=p)
    return zstd.ZstdCompressor(dict_data=d, compression_params=p).compress


@lru_cache(maxsize=4)
def _pair(toxic: bytes, ordinary: bytes):
    return _compressor(ordinary), _compressor(toxic + ordinary)


def features(text: str, toxic: bytes, ordinary: bytes) -> list[float]:
    """Pooled bytes that the toxic dictionary saves in the windows of the whole text."""
    plain, both = _pair(toxic, ordinary)
    raw = text.lower().encode("utf-8", "replace")
    saved = np.array([len(plain(w)) - len(both(w)) for w in windows(raw)], dtype=np.float64)
    kb = len(raw) / 1000 + 0.1
    if not len(saved):
        saved = np.zeros(1)
    return [np.log1p(max(saved.max(), 0)), np.log1p(np.clip(saved, 0, None).sum() / kb),
            np.sqrt((saved >= 3).sum() / kb), np.sqrt((saved >= 5).sum() / kb),
            np.clip(saved, -3, 8).mean(), np.log(kb)]


def score(model: Model, text: str) -> float:
    f = (np.array(features(text, model.toxic, model.ordinary)) - model.mean) / model.scale
    return float(1 / (1 + np.exp(-np.clip(f @ np.array(model.weights[:-1]) + model.weights[-1], -30, 30))))


# ----------------------------------------------------------------- training

def _sequences(word: str) -> set[str]:
    b = f" {word} "
    return {b[i:i + 5] for i in range(len(b) - 4)}


def _train_dictionary(samples: list[bytes], size: int, **cover) -> bytes:
    """A trained dictionary, or the distinct samples themselves where they are too few to train."""
    try:
        return zstd.train_dictionary(size, samples, **cover).as_bytes()
    except zstd.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Ridge logistic regression by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    b = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        s = weight * (p * (1 - p) + 1e-9)
        b += np.linalg.solve((z * s[:, None]).T @ z + 0.1 * np.eye(len(b)), z.T @ (weight * (y - p)) - 0.1 * b)
    return tuple(mean), tuple(scale), tuple(b)


def train(toxic: list[str], ordinary: list[str], toxic_share: float, seed: int = 7) -> Model | None:
    """Dictionaries from two thirds of the rows, thresholds calibrated on the rest.

    ``toxic_share`` is the class's share among all labelled rows (the sample
    is balanced otherwise). None if a class is missing.
    """
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    if not toxic or not ordinary:
        return None
    rng = np.random.default_rng(seed)
    cut = lambda rows: (rows[:max(1, len(rows) * 2 // 3)], rows[max(1, len(rows) * 2 // 3):] or rows)
    (tox, tox_fit), (ordi, ordi_fit) = cut(toxic), cut(ordinary)

    tox_words = [_WORDS.findall(t.lower()) for t in tox]
    in_tox = Counter(w for ws in tox_words for w in set(ws))
    seq_t: Counter = Counter()
    for w, n in in_tox.items():
        for g in _sequences(w):
            seq_t[g] += n
    seq_t = Counter({g: n for g, n in seq_t.items() if n * np.log(n * len(ordi) + 2) >= MIN_EVIDENCE})
    seq_o: Counter = Counter()                  # of the sequences that can matter, to stay small
    for t in ordi:
        for w in set(_WORDS.findall(t.lower())):
            seq_o.update(g for g in _sequences(w) if g in seq_t)
    marks = set()
    for g, n in seq_t.items():
        ratio = (n + .5) / (len(tox) + 1) * (len(ordi) + 1) / (seq_o[g] + .5)
        if ratio >= MIN_RATIO and n * np.log(ratio) >= MIN_EVIDENCE:
            marks.add(g)
    marked = {w for w in in_tox if not marks.isdisjoint(_sequences(w))}
    said = [f" {w}".encode() for ws in tox_words for w in ws if w in marked]
    toxic_dict = _train_dictionary([b"".join(said[i:i + 6]) for i in range(0, len(said), 6)] or [b" "],
                                   TOXIC_DICT, k=32, d=6)
    plain = []
    for t in ordi:
        ws = list(windows(t.lower().encode("utf-8", "replace")))
        plain += [ws[i] for i in rng.choice(len(ws), min(WINDOWS_PER_ROW, len(ws)), replace=False)]
    rng.shuffle(plain)
    ordinary_dict = b"".join(_train_dictionary(plain[k::ORDINARY_PARTS] or [b" "], ORDINARY_DICT)
                             for k in range(ORDINARY_PARTS))
    ordi_fit = ordi_fit[:max(200, 2 * len(tox_fit))]
    x = np.array([features(t, toxic_dict, ordinary_dict) for t in tox_fit + ordi_fit])
    y = np.r_[np.ones(len(tox_fit)), np.zeros(len(ordi_fit))]
    share = min(max(toxic_share, 1e-4), 1 - 1e-4)
    weight = np.where(y == 1, share / len(tox_fit), (1 - share) / len(ordi_fit)) * len(y)
    return Model(toxic_dict, ordinary_dict, *_logistic(x, y, weight))


def train_on(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> Model | None:
    """Fit on at most ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` labelled rows, those with the smallest hash of the id.

    ``learn`` is a condition on ``id_col`` that keeps held-out rows away. The
    ids are chosen from the labels alone, so no text is shuffled to find them.
    Null labels, null, empty and overlong texts are skipped; an id labelled
    both ways counts as toxic; of rows repeating an id one text is taken.
    """
    flag = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(learn)
            .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic")))
    shares = {r.toxic: r.n for r in flag.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}

    def first(y: int, most: int) -> DataFrame:
        return flag.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(most)

    # at most TOXIC_ROWS + ORDINARY_ROWS ids: small enough for every task
    chosen = first(1, TOXIC_ROWS).unionByName(first(0, ORDINARY_ROWS))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .where(f"length(text) BETWEEN 1 AND {MAX_TRAIN_CHARS}").join(F.broadcast(chosen), "id")
            .groupBy("id", "toxic").agg(F.min("text").alias("text"))
            .orderBy("toxic", F.xxhash64("id"), "id").select("text", "toxic").toArrow())
    text, toxic = rows.column("text").to_pylist(), rows.column("toxic").to_pylist()
    return train([t for t, y in zip(text, toxic) if y == 1], [t for t, y in zip(text, toxic) if y == 0],
                 shares.get(1, 0) / max(1, sum(shares.values())))


@shielded
def toxicity(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Every row of ``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Whole texts are scored, a null text like an empty one (no window saves
    anything). Without a model (a class had no rows) every score is 0. Equal
    texts get equal scores, repeated rows are answered each; a very long text
    is scored window by window; an empty table gives an empty result; input
    columns named like an output are replaced.
    """
    docs = without(docs, "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in batches:
            yield pa.array([score(m, t.as_py()) if m else 0.0 for t in texts], pa.float64())

    return (docs.withColumn("score", scored(F.coalesce(F.col(text_col), F.lit(""))))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
