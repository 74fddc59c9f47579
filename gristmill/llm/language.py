"""Language identification with a string kernel.

Texts are compared by the byte n-grams of one to three they hold (blended spectrum, presence only, cosine-normalised).
Nyström landmarks give every text a short feature vector, and one ridge regression per language is fitted on those. With
presence in a matrix P (texts x n-grams of the landmarks), the kernel with all landmarks is the product P·Zᵀ, and the
prediction P·Zᵀ·A; Zᵀ·A is multiplied out once, so a batch of texts costs one sparse-by-small product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import first_keys, hash128, prepare, small, table, worker_state

UNDETERMINED = "und"
#: The sample the model is fitted on: rows per language and in all, one per language at least, and characters of a text in it.
PER_LANGUAGE, SAMPLE_ROWS, SAMPLE_CHARS = 400, 20_000, 20_000
#: Landmarks per language and in all, one per language at least.
LANDMARKS_PER_LANGUAGE, LANDMARKS = 64, 1024
RIDGE = 1e-3
_LETTER = r"\p{L}"
LETTER = regex.compile(_LETTER)
_SIZES = (1, 2, 3)
_BASE = np.array([0, 0, 1 << 8, (1 << 8) + (1 << 16)], np.int64)
_CHUNK = 1 << 20
_GRAMS = 1 << 14


def ngram_codes(text: bytes) -> np.ndarray:
    """Numbers of all n-grams of one to three bytes, repeats included."""
    data = np.frombuffer(text, np.uint8).astype(np.int32)
    out = [data]
    for size in _SIZES[1:]:
        if len(data) >= size:
            code = data[: len(data) - size + 1].copy()
            for k in range(1, size):
                code <<= 8
                code |= data[k : len(data) - size + 1 + k]
            out.append(code + np.int32(_BASE[size]))
    return np.concatenate(out)


class Model:
    """``slots`` numbers the n-grams of the landmarks (0: none of them); ``weights`` has a column per language."""

    def __init__(self, languages: list[str], grams: np.ndarray, weights: np.ndarray):
        self.languages, self.grams, self.weights = languages, grams, weights
        self._slots = None

    def __getstate__(self):
        return self.__dict__ | {"_slots": None}

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.zeros(int(_BASE[3]) + (1 << 24), np.uint16 if len(self.grams) < 65_535 else np.int32)
            self._slots[self.grams] = np.arange(1, len(self.grams) + 1)
        return self._slots

    def presence(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.grams) + 1), np.float32)
        for i, text in enumerate(texts):
            for at in range(0, max(len(text), 1), _CHUNK):
                out[i, self.slots[ngram_codes(text[at : at + _CHUNK + 2])]] = 1
        return out[:, 1:]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        held = self.presence(texts)
        norm = np.sqrt(np.maximum(held.sum(axis=1), 1))
        return (held @ self.weights) / norm[:, None]


def _held(texts: list[bytes], grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) of every landmark n-gram that a text holds, both as numbers, by n-gram."""
    rows, slots = [], []
    for i, text in enumerate(texts):
        codes = np.unique(np.concatenate([np.unique(ngram_codes(text[at : at + _CHUNK + 2])) for at in range(0, max(len(text), 1), _CHUNK)]))
        at = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
        at = at[grams[at] == codes]
        rows.append(np.full(len(at), i, np.int32))
        slots.append(at.astype(np.int32))
    row, slot = np.concatenate(rows), np.concatenate(slots)
    order = np.argsort(slot, kind="stable")
    return row[order], slot[order]


def _parts(held: tuple[np.ndarray, np.ndarray], n: int, grams: int) -> Iterator[np.ndarray]:
    """Presence of a stretch of n-grams after the other, each a small dense matrix."""
    row, slot = held
    for start in range(0, grams, _GRAMS):
        a, b = np.searchsorted(slot, [start, start + _GRAMS])
        part = np.zeros((n, min(_GRAMS, grams - start)), np.float32)
        part[row[a:b], slot[a:b] - start] = 1
        yield part


def kernel(a: list[bytes], b: list[bytes], grams: np.ndarray) -> np.ndarray:
    """Cosine-normalised numbers of shared n-grams, of every text of ``a`` with every one of ``b``."""
    held = _held(a, grams), _held(b, grams)
    shared = np.zeros((len(a), len(b)), np.float32)
    for x, y in zip(_parts(held[0], len(a), len(grams)), _parts(held[1], len(b), len(grams))):
        shared += x @ y.T
    size = [np.sqrt(np.maximum(np.bincount(row, minlength=n), 1)) for (row, _), n in zip(held, (len(a), len(b)))]
    return shared / size[0][:, None] / size[1]


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """One ridge regression per language on the landmarks' features.

    Texts pass in batches that leave sums of landmark size only, so memory grows with landmarks times n-grams present, not
    with texts times n-grams.
    """
    names = sorted(set(languages))
    encoded = [t.lower().encode() for t in texts]
    each = max(1, min(landmarks, LANDMARKS // len(names)))
    chosen = [i for name in names for i in [k for k, x in enumerate(languages) if x == name][:each]]
    basis = [encoded[i] for i in chosen]
    grams = np.unique(np.concatenate([np.unique(ngram_codes(t)) for t in basis]))
    values, vectors = np.linalg.eigh(kernel(basis, basis, grams).astype(np.float64))
    keep = values > 1e-8 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    column = {name: k for k, name in enumerate(names)}
    squares, wanted = np.zeros((whiten.shape[1],) * 2), np.zeros((whiten.shape[1], len(names)))
    for at in range(0, len(encoded), 200):
        features = kernel(encoded[at : at + 200], basis, grams).astype(np.float64) @ whiten
        target = np.zeros((len(features), len(names)))
        target[np.arange(len(features)), [column[x] for x in languages[at : at + 200]]] = 1
        squares += features.T @ features
        wanted += features.T @ target
    solved = np.linalg.solve(squares + ridge * len(texts) * np.eye(len(squares)), wanted)
    of_landmarks = (whiten @ solved).astype(np.float32)
    held = _held(basis, grams)
    of_landmarks /= np.sqrt(np.maximum(np.bincount(held[0], minlength=len(basis)), 1))[:, None].astype(np.float32)
    weights = np.concatenate([part.T @ of_landmarks for part in _parts(held, len(basis), len(grams))])
    return Model(names, grams, weights)


def lettered(text: Column) -> Column:
    """Whether ``LETTER`` is in a text; null texts have none."""
    return F.coalesce(F.rlike(text, F.lit(_LETTER)), F.lit(False))


def sample(docs: DataFrame, learn: Column, text_column: str, lang_column: str) -> DataFrame:
    """(lang, text, place): the bounded training sample, per language the different texts with the smallest hashes.

    Texts of more than ``SAMPLE_CHARS`` characters are left to languages without a shorter one: of those the shortest are taken, and of
    each so many characters from its first letter. Hashes alone are ranked; the texts that are taken are fetched afterwards.
    """
    text = F.col(text_column)
    usable = docs.where(learn & F.col(lang_column).isNotNull() & F.rlike(text, F.lit(_LETTER)))
    h1, h2 = hash128(F.col("text"), "sample")
    narrow = usable.select(text.alias("text"), F.col(lang_column).alias("lang"), F.length(text).alias("chars"))
    narrow = narrow.withColumn("h1", h1).withColumn("h2", h2)
    fits = F.col("chars") <= SAMPLE_CHARS
    least = narrow.groupBy("lang").agg(F.min("chars").alias("least")).collect()
    long_only = [r["lang"] for r in least if r["least"] > SAMPLE_CHARS]
    taken = narrow.where(fits | F.col("lang").isin(long_only)).withColumn("over", F.when(~fits, F.col("chars")))
    each = max(1, min(PER_LANGUAGE, SAMPLE_ROWS // max(1, len(least))))
    keys = first_keys(taken, "lang", ["over", "h1", "h2"], each).drop("over")
    cut = F.left(F.regexp_replace("text", r"^\P{L}++", ""), F.lit(SAMPLE_CHARS))
    fetched = taken.join(small(keys), ["lang", "h1", "h2"]).dropDuplicates(["lang", "h1", "h2"])
    return fetched.select("lang", F.when(fits, F.col("text")).otherwise(cut).alias("text"), "place")


def identify(
    docs: DataFrame, training: DataFrame | None = None, learn: Column | None = None, text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """``docs`` with lang_pred and score (existing columns of these names give way).

    The model learns from text and language of the rows of ``training`` (``docs`` itself if none is given) for which ``learn``
    holds, from a bounded sample of them. ``score`` is the winning regression value cut to 0..1. Null texts and texts without a letter
    are ``und`` with score 0, and so is everything if nothing can be learned. Ties go to the first language by name.
    Repeated rows get equal results and are one in the sample; a text of any length is read whole; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    source = docs if training is None else training
    rows = sample(source, F.lit(True) if learn is None else learn, text_column, lang_column).orderBy("lang", "place", "text").collect()
    model = fit([r["text"] for r in rows], [r["lang"] for r in rows]) if rows else None
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index(text_column)
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(None)
        for batch in batches:
            names, values = [], []
            for start in range(0, batch.num_rows, 64):
                texts = batch.column(at).slice(start, 64).to_pylist()
                lettered = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if model else []
                name, value = [UNDETERMINED] * len(texts), [0.0] * len(texts)
                if lettered:
                    scores = model.scores([texts[i].lower().encode() for i in lettered])
                    for i, row in zip(lettered, scores):
                        best = int(row.argmax())
                        name[i], value[i] = model.languages[best], float(min(max(row[best], 0.0), 1.0))
                names += name
                values += value
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    return docs.select(*kept).mapInArrow(run, schema)


def remainder(id_column: str = "doc_id") -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 4


def op9_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = F.coalesce(remainder() != 2, F.lit(True))
    done = identify(docs.select("doc_id", "text"), training=docs, learn=learn)
    return done.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
