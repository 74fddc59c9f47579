"""Batch inference over a text column with a pluggable encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tokens whose components a worker remembers before it starts over.
REMEMBERED_TOKENS = 100_000

Encoder = Callable[[Sequence[str]], np.ndarray]
EncoderFactory = Callable[[], Encoder]


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length in float precision; zero rows stay zero."""
    values = np.asarray(matrix, dtype=np.float32)
    norms = np.sqrt(np.einsum("ij,ij->i", values, values, dtype=np.float64)).astype(np.float32)
    norms[norms == 0] = 1.0
    return values / norms[:, None]


def embed(text: Column, factory: EncoderFactory, batch_size: int = 32, normalize: bool = True) -> Column:
    """A vector per text; null for a null text.

    The factory runs once per Python worker, so a model is loaded once and reused for all batches of the
    tasks on that worker. Texts reach it in batches of at most ``batch_size`` rows.
    """

    def make_predict() -> Callable[[np.ndarray], np.ndarray]:
        encode = factory()

        def predict(texts: np.ndarray) -> np.ndarray:
            vectors = np.asarray(encode([str(t) for t in texts.ravel()]), dtype=np.float32)
            return unit_rows(vectors) if normalize else vectors

        return predict

    udf = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return F.when(text.isNotNull(), udf(F.coalesce(text, F.lit(""))))


class _Slots(dict):
    """The component of each token met so far."""

    def __init__(self, dim: int):
        super().__init__()
        self._dim = dim

    def __missing__(self, token: str) -> int:
        slot = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16) % self._dim
        self[token] = slot
        return slot


def hashed_tokens(dim: int) -> EncoderFactory:
    """Dependency-free encoder: counts of space-separated tokens, each hashed to a component."""

    def factory() -> Encoder:
        slots = _Slots(dim)

        def encode(texts: Sequence[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                found = np.array([slots[token] for token in text.split(" ") if token], dtype=np.int64)
                out[row] = np.bincount(found, minlength=dim)
            if len(slots) > REMEMBERED_TOKENS:
                slots.clear()
            return out

        return encode

    return factory
