"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded
sample, labels every byte position of the whole text, and the position
probabilities are averaged into the document's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import shielded, without

HIDDEN = 8
#: Bytes per segment; the recurrent states start anew at each segment.
STEP = 128
#: Training sample: rows per language, their largest length, and segments per row.
ROWS_PER_LANG = 400
MAX_TRAIN_CHARS = 100_000
SEGMENTS_PER_ROW = 4
TRAIN_STEPS = 320
BATCH = 128
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    """``w`` byte table (2, 3h, 256), ``u`` recurrent (2, 3h, h), ``v`` output (C, 2h), ``c`` bias (C).

    Axis 0 is the direction (0 reads forward, 1 backward); the 3h rows are
    update gate, reset gate and candidate.
    """
    langs: list[str]
    w: np.ndarray
    u: np.ndarray
    v: np.ndarray
    c: np.ndarray


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes [STEP, S], real bytes per segment [S], text of each segment [S])."""
    parts, lens, owner = [], [], []
    for k, t in enumerate(texts):
        n = -(-len(t) // STEP)
        parts.append(t.ljust(n * STEP, b"\0"))
        lens += [STEP] * (n - 1) + [len(t) - (n - 1) * STEP] if n else []
        owner += [k] * n
    x = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, STEP).T     # one byte each; widened block by block
    return x, np.array(lens, np.int64), np.array(owner, np.int64)


def _run(x: np.ndarray, w: np.ndarray, u: np.ndarray, backward: bool) -> np.ndarray:
    """Hidden states [T, h, S] of one direction (gates by tanh: s(a) = (1 + tanh(a/2)) / 2)."""
    steps, n = x.shape
    h = u.shape[1]
    w, u = w.copy(), u.copy()
    w[:2 * h] *= 0.5
    u[:2 * h] *= 0.5
    s = np.zeros((h, n), np.float32)
    g, hu = np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
    out = np.empty((steps, h, n), np.float32)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        np.take(w, x[t], axis=1, out=g, mode="clip")
        np.dot(u, s, out=hu)
        gates = g[:2 * h]
        gates += hu[:2 * h]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        cand = hu[2 * h:]
        cand *= gates[h:]
        cand += g[2 * h:]
        np.tanh(cand, out=cand)
        s -= cand
        s *= gates[:h]
        s += cand
        out[t] = s
    return out


def position_probabilities(m: Model, x: np.ndarray) -> np.ndarray:
    """Probabilities [C, T, S] of every byte position."""
    states = np.concatenate([_run(x, m.w[0], m.u[0], False), _run(x, m.w[1], m.u[1], True)], axis=1)
    logits = np.matmul(m.v, states) + m.c[:, None]          # [T, C, S]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits.transpose(1, 0, 2)


def pooled(m: Model, texts: list[bytes], block: int = 1024) -> np.ndarray:
    """Mean position probabilities [text, C]; zeros for empty texts."""
    x, lens, owner = segments(texts)
    sums = np.zeros((len(texts), len(m.langs)))
    for a in range(0, x.shape[1], block):
        n = lens[a:a + block]
        p = position_probabilities(m, np.ascontiguousarray(x[:, a:a + block], np.int64))
        full = p.sum(axis=1, dtype=np.float64)              # [C, S]
        for k in np.flatnonzero(n < STEP):                  # padding has no say
            full[:, k] = p[:, :n[k], k].sum(axis=1)
        for c in range(len(m.langs)):
            sums[:, c] += np.bincount(owner[a:a + block], weights=full[c], minlength=len(texts))
    return sums / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


# ----------------------------------------------------------------- training

def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * a)


def _forward_pass(x, w, u, backward):
    h = u.shape[1]
    order = range(x.shape[0] - 1, -1, -1) if backward else range(x.shape[0])
    s, tape = np.zeros((h, x.shape[1]), np.float32), []
    states = np.empty((x.shape[0], h, x.shape[1]), np.float32)
    for t in order:
        g, hu = w[:, x[t]], u @ s
        zr = _sigmoid(g[:2 * h] + hu[:2 * h])
        n = np.tanh(g[2 * h:] + zr[h:] * hu[2 * h:])
        tape.append((t, s, zr, n, hu[2 * h:]))
        s = n + zr[:h] * (s - n)
        states[t] = s
    return states, tape


def _backward_pass(x, u, tape, d_states):
    """Gradients of the byte table and the recurrent weights, through all steps."""
    h = u.shape[1]
    du = np.zeros_like(u)
    dg = np.empty((x.shape[0], 3 * h, x.shape[1]), np.float32)
    ds = np.zeros_like(d_states[0])
    for t, s, zr, n, hun in reversed(tape):
        ds = ds + d_states[t]
        z, r = zr[:h], zr[h:]
        dn = ds * (1 - z) * (1 - n * n)
        dz = ds * (s - n) * z * (1 - z)
        dr = dn * hun * r * (1 - r)
        dg[t] = np.concatenate((dz, dr, dn))
        dhu = np.concatenate((dz, dr, dn * r))
        du += dhu @ s.T
        ds = ds * z + u.T @ dhu
    flat, idx = dg.transpose(1, 0, 2).reshape(3 * h, -1), x.reshape(-1)
    dw = np.stack([np.bincount(idx, weights=row, minlength=256) for row in flat]).astype(np.float32)
    return dw, du


def train(texts: list[bytes], langs: list[str], steps: int = TRAIN_STEPS, seed: int = 7) -> Model | None:
    """Adam on random segments, the loss averaged over all byte positions; None without texts."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    cut, y = [], []
    for t, l in zip(texts, langs):
        starts = range(0, max(1, len(t)), STEP)
        for a in (rng.choice(starts, min(SEGMENTS_PER_ROW, len(starts)), replace=False)):
            if t[a:a + STEP]:
                cut.append(t[a:a + STEP])
                y.append(names.index(l))
    x, lens, owner = segments(cut)
    x = np.ascontiguousarray(x, np.int64)
    y = np.array(y)[owner]
    per = [np.flatnonzero(y == k) for k in range(len(names))]
    per = [p for p in per if len(p)]
    h, n_c = HIDDEN, len(names)
    scale = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    params = [scale(2, 3 * h, 256), scale(2, 3 * h, h), scale(n_c, 2 * h), np.zeros(n_c, np.float32)]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        # languages are drawn evenly
        pick = np.concatenate([rng.choice(p, -(-BATCH // len(per))) for p in per]) if per else np.array([], int)
        if not len(pick):
            break
        xb, yb, nb = x[:, pick], y[pick], lens[pick]
        w, u, v, c = params
        runs = [_forward_pass(xb, w[d], u[d], bool(d)) for d in (0, 1)]
        states = np.concatenate([r[0] for r in runs], axis=1)
        logits = np.matmul(v, states) + c[:, None]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[:, yb, np.arange(len(yb))] -= 1
        mask = np.arange(STEP)[:, None] < nb
        d = (p * (mask / mask.sum())[:, None, :]).astype(np.float32)
        dv = np.einsum("tcs,ths->ch", d, states, optimize=True)
        d_states = np.matmul(v.T, d)
        grads = [_backward_pass(xb, u[k], runs[k][1], d_states[:, k * h:(k + 1) * h]) for k in (0, 1)]
        grads = [np.stack([g[0] for g in grads]), np.stack([g[1] for g in grads]), dv, d.sum(axis=(0, 2))]
        rate = 0.02 * min(1.0, 1.5 * (1 - step / (steps + 1)))
        for k, g in enumerate(grads):
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.99 * m2[k] + 0.01 * g * g
            params[k] = (params[k] - rate * (m1[k] / (1 - 0.9 ** step))
                         / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return Model(names, *params)


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn,
                  per_lang: int = ROWS_PER_LANG) -> tuple[list[bytes], list[str]]:
    """At most ``per_lang`` texts of each language, those with the smallest hash; equal texts count once.

    The hashes are ranked alone; the texts are then fetched by the chosen
    ones, at most ``per_lang`` a language, so no text is shuffled to rank it.
    """
    w = Window.partitionBy("lang").orderBy("h")
    rows = (docs.where(learn).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .where("lang IS NOT NULL AND length(text) BETWEEN 1 AND %d" % MAX_TRAIN_CHARS)
            .withColumn("h", F.xxhash64("text")))
    # equal hashes are one row: a text with many copies is combined before the exchange
    chosen = (rows.groupBy("lang", "h").agg(F.lit(1).alias("one")).withColumn("k", F.row_number().over(w))
              .where(F.col("k") <= per_lang).select("lang", "h", "k"))
    got = (rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "k").agg(F.min("text").alias("text"))
           .orderBy("lang", "k").select("text", "lang").toArrow())
    return [t.encode() for t in got.column("text").to_pylist()], got.column("lang").to_pylist()


@shielded
def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` plus ``lang_pred, score``.

    ``und`` with score 0 if the text is null, empty or has no letter (or the
    model learned nothing). Equal texts get equal results; repeated rows are
    answered each; a very long text is read whole, in blocks of segments; an
    empty table gives an empty result; input columns named like an output
    column are replaced.
    """
    docs = without(docs, "lang_pred", "score")
    kind = "struct<lang_pred:string,score:double>"

    @F.arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = [], []
            for texts in _by_bytes(batch):
                probs = pooled(model, texts) if model else None
                for k, t in enumerate(texts):
                    if model is None or not _LETTER.search(t.decode("utf-8", "replace")):
                        names.append(UNDETERMINED)
                        scores.append(0.0)
                    else:
                        best = int(np.argmax(probs[k]))
                        names.append(model.langs[best])
                        scores.append(float(min(1.0, probs[k][best])))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             ["lang_pred", "score"])

    found = docs.withColumn("__p", predict(F.coalesce(F.col(text_col), F.lit(""))))
    return found.select(*docs.columns, "__p.lang_pred", "__p.score")


def _by_bytes(batch: pa.Array, most: int = 4 << 20) -> Iterator[list[bytes]]:
    held, size = [], 0
    for x in batch.cast(pa.binary()):
        held.append(x.as_py())
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
