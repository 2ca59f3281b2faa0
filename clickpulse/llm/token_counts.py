"""Token counts of whole texts by a public tokenizer, lengths only.

An Arrow function encodes batches that are balanced by bytes and returns one
number per text; token ids never leave the batch. Long texts are cut at *safe
boundaries*, where the model provably cannot merge across the cut, so the
parts' counts add up to the count of the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import shielded, without

#: Bytes encoded by one library call, and the part size of long texts (characters).
BATCH_BYTES = 256 * 1024
PART_CHARS = 16 * 1024
_MARK = "▁"           # the piece models' sign for a space


class PieceCounter:
    """Counts with a sentencepiece model (bytes of the ``.model`` file)."""

    def __init__(self, model: bytes):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb2
        self.sp = spm.SentencePieceProcessor(model_proto=model)
        proto = pb2.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        # cutting is proved only for models that leave the text as it is
        self.can_cut = (not norm.precompiled_charsmap and norm.add_dummy_prefix
                        and norm.escape_whitespaces and not norm.remove_extra_whitespaces
                        and not proto.trainer_spec.treat_whitespace_as_suffix
                        and proto.trainer_spec.model_type == 2)
        # neighbouring characters that some piece holds; a cut elsewhere crosses no merge
        pieces = [p.piece for p in proto.pieces if p.type in (1, 4)]
        self.pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}

    def cut(self, text: str) -> tuple[list[str], int]:
        """Parts of ``text`` and the tokens to subtract from their summed counts."""
        if not self.can_cut or len(text) <= PART_CHARS:
            return [text], 0
        parts, extra, start = [], 0, 0
        while len(text) - start > PART_CHARS:
            at, skip, minus = self._boundary(text, start + PART_CHARS // 2, start)
            if at < 0:
                break
            parts.append(text[start:at])
            extra += minus
            start = at + skip
        parts.append(text[start:])
        return parts, extra

    def _boundary(self, text: str, lo: int, start: int) -> tuple[int, int, int]:
        """First safe cut at or after ``lo``: (position, characters dropped, tokens added)."""
        pairs = self.pairs
        prev = text[lo - 1].replace(" ", _MARK)
        for i in range(lo, len(text) - 1):
            c = text[i].replace(" ", _MARK)
            if prev + c not in pairs:
                # a lone space is the mark that the next part gets in front anyway
                if c == _MARK:
                    if text[i + 1] not in (" ", _MARK):
                        return i, 1, 0
                elif _MARK + c not in pairs:
                    return i, 0, 1          # the part's own mark stays a token by itself
            prev = c
        return -1, 0, 0

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.sp.encode(texts, num_threads=1)]


class JsonCounter:
    """Counts with a ``tokenizers`` file; texts are not cut."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_buffer(model)
        self.tok.no_truncation()
        self.tok.no_padding()

    def cut(self, text: str) -> tuple[list[str], int]:
        return [text], 0

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def counter(kind: str, model: bytes) -> PieceCounter | JsonCounter:
    return PieceCounter(model) if kind == "model" else JsonCounter(model)


def count_texts(c: PieceCounter | JsonCounter, texts: Iterator[str | None]) -> list[int]:
    """Counts in order; library calls hold about ``BATCH_BYTES`` of text each."""
    totals: list[int] = []
    batch: list[str] = []
    owners: list[int] = []
    size = 0

    def flush():
        nonlocal size
        for k, n in zip(owners, c.counts(batch)):
            totals[k] += n
        batch.clear()
        owners.clear()
        size = 0

    for t in texts:
        parts, extra = c.cut(t or "")
        totals.append(-extra)
        for p in parts:
            batch.append(p)
            owners.append(len(totals) - 1)
            size += len(p.encode("utf-8", "surrogatepass")) if len(p) > 4096 else 2 * len(p)
            if size >= BATCH_BYTES:
                flush()
    flush()
    return totals


def token_count_udf(path: str) -> Callable:
    """Arrow function text -> token count; the model file travels with the task."""
    with open(path, "rb") as f:
        model = f.read()
    kind = path.rsplit(".", 1)[-1]

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = counter(kind, model)
        for texts in batches:
            yield pa.array(count_texts(c, (x.as_py() for x in texts)), pa.int64())

    return count


@shielded
def token_counts(docs: DataFrame, path: str, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Every row of ``docs`` plus ``n_bytes, n_tokens, over_limit``.

    A null text counts as empty (0 bytes, 0 tokens). Texts of any length are
    counted whole; a long text without a safe boundary is encoded in one call.
    Repeated rows are counted each; an empty table gives an empty result;
    input columns named like an output column are replaced. ``path`` is read
    on the driver (a vocabulary file, megabytes).
    """
    docs = without(docs, "n_bytes", "n_tokens", "over_limit")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.withColumn("n_bytes", F.octet_length(text).cast("bigint"))
            .withColumn("n_tokens", token_count_udf(path)(text))
            .withColumn("over_limit", F.col("n_tokens") > limit))
