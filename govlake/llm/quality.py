"""A quality classifier on supervised subword embeddings.

Every word, its character n-grams and the distance at which a word comes back are hashed to learned
vectors; a document is their average; a softmax layer gives the label. Vectors and layer are
trained together by stochastic gradient descent in numpy on a bounded sample of labelled rows. As
averaging and the layer are linear, scoring needs one number per word, kept in a bounded table.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .shared import text_of, unused

BUCKETS, DIMENSIONS = 2**17, 12
SHORTEST, LONGEST = 3, 4
#: Distances at which a word that comes back counts, each as so many features.
DISTANCES, WEIGHT = 8, 6
#: The longest step of the descent, in the norm of what it moves.
STEP = 1.0
#: Labelled rows to fit on, at most; chosen by a hash of doc_id.
SAMPLE = 4000
_REMEMBERED = 400_000
_CHARS = 128  # longer words are remembered by a digest
_PIECE = 65_536  # n-grams of a word at a time


def subwords(word: str) -> Iterator[list[int]]:
    """Buckets of a word and of all its character n-grams, in pieces of bounded length."""
    marked = f"<{word}>"
    out = [zlib.crc32(word.encode()) % BUCKETS]
    for n in range(SHORTEST, LONGEST + 1):
        for at in range(0, len(marked) - n + 1, _PIECE):
            out += [zlib.crc32(marked[i:i + n].encode(), n) % BUCKETS
                    for i in range(at, min(at + _PIECE, len(marked) - n + 1))]
            if len(out) > _PIECE:
                yield out
                out = []
    yield out


#: Buckets of the features that are not subwords: the end of the text, and returns by distance.
END = zlib.crc32(b"", 99) % BUCKETS
RETURNS = [zlib.crc32(b"return", 100 + d) % BUCKETS for d in range(1, DISTANCES + 1)]


def _returns(ids: np.ndarray) -> list[int]:
    return [int((ids[d:] == ids[:-d]).sum()) if len(ids) > d else 0 for d in range(1, DISTANCES + 1)]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and how often each counts."""
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in (text or "").split()], np.int64)
    often = np.bincount(ids, minlength=len(numbers)).tolist()
    total: dict[int, int] = {END: 1}
    for word, n in zip(numbers, often, strict=True):
        for piece in subwords(word):
            for bucket in piece:
                total[bucket] = total.get(bucket, 0) + n
    for bucket, n in zip(RETURNS, _returns(ids), strict=True):
        if n:
            total[bucket] = total.get(bucket, 0) + WEIGHT * n
    return np.fromiter(total, np.int64, len(total)), np.fromiter(total.values(), np.float32, len(total))


@dataclass
class Model:
    vectors: np.ndarray  # bucket x dimension
    layer: np.ndarray    # label x dimension

    def table(self) -> np.ndarray:
        """Per bucket, how much it speaks for label 1 against label 0."""
        return (self.vectors @ (self.layer[1] - self.layer[0])).astype(np.float32)


def _within(step: np.ndarray) -> np.ndarray:
    size = float(np.linalg.norm(step))
    return step if size <= STEP else step * (STEP / size)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 5, rate: float = 1.5,
          seed: int = 6) -> Model:
    """Stochastic gradient descent, one document at a time, over (buckets, counts, label)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((2, DIMENSIONS), np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, counts, label = rows[i]
            share = counts / counts.sum()
            mean = share @ vectors[buckets]
            logits = layer @ mean
            odds = np.exp(logits - logits.max())
            error = (odds / odds.sum()).astype(np.float32)
            error[label] -= 1
            step = rate * (1 - done / steps)
            back = error @ layer
            # the gradient of an average is tiny per feature; scale it up as if each stood alone
            scale = np.sqrt(len(buckets))
            # no step moves the layer or the document's mean by more than STEP, or few features that make
            # up a whole text would drive both up without end
            layer -= _within(step * np.outer(error, mean))
            moved = step * scale * float(share @ share) * float(np.linalg.norm(back))
            vectors[buckets] -= (step * scale * min(1.0, STEP / max(moved, 1e-12)) * share)[:, None] * back
            done += 1
    return Model(vectors, layer)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled rows that are not held out.

    The sample is what is gathered on the driver: `sample` lists of buckets, as of several texts
    under one doc_id the one of the least hash is taken. Rows with a null label, a null doc_id or a
    label other than 0 and 1 are left out. Without any row the model scores everything 0.5."""
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select("doc_id", F.col("quality").cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample))
    # bounded by the sample, whatever the size of the labels
    texts = (docs.select("doc_id", text_of().alias("text"), F.xxhash64(text_of()).alias("key"))
             .join(F.broadcast(chosen), "doc_id"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [features(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "key": batch["key"],
                                "buckets": [b.astype("<i4").tobytes() for b, _ in made],
                                "counts": [c.astype("<f4").tobytes() for _, c in made]})

    made = texts.mapInPandas(run, "doc_id long, label int, key long, buckets binary, counts binary")
    rows = (made.groupBy("doc_id", "label").agg(F.min_by(F.struct("buckets", "counts"), "key").alias("of"))
            .select("doc_id", "label", "of.*").collect())
    rows.sort(key=lambda r: (r.doc_id, r.label, bytes(r.buckets)))
    return train([(np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.counts, "<f4"), r.label)
                  for r in rows])


class _Words(dict):
    """Word -> number of its place in arrays of score and feature count. Long words are kept by a
    digest, so what is kept does not grow with their length."""

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table
        self.score = np.zeros(_REMEMBERED)
        self.count = np.zeros(_REMEMBERED)

    def __missing__(self, word: str) -> int:
        key = word if len(word) <= _CHARS else hashlib.blake2b(word.encode(), digest_size=16).digest()
        if key is not word and key in self:
            return self[key]
        place = len(self)
        if place >= len(self.score):
            self.score, self.count = (np.concatenate([a, np.zeros(len(a))]) for a in (self.score, self.count))
        for piece in subwords(word):
            self.score[place] += self.table[piece].sum()
            self.count[place] += len(piece)
        self[key] = place
        return place

    def logit(self, text: str | None) -> float:
        if len(self) >= _REMEMBERED:
            self.clear()
            self.score, self.count = np.zeros(_REMEMBERED), np.zeros(_REMEMBERED)
        ids = np.fromiter(map(self.__getitem__, (text or "").split()), np.int64)
        back = _returns(ids)
        total = self.score[ids].sum() + self.table[END] + WEIGHT * sum(
            self.table[b] * n for b, n in zip(RETURNS, back, strict=True))
        return float(total / (self.count[ids].sum() + 1 + WEIGHT * sum(back)))


@functools.lru_cache(maxsize=2)
def _words(table: bytes) -> _Words:
    return _Words(np.frombuffer(table, "<f4"))


def score(text: Column, model: Model) -> Column:
    """Probability of label 1, for the whole text; also for null and empty ones."""
    table = model.table().astype("<f4").tobytes()  # half a megabyte, whatever the corpus

    @F.pandas_udf(DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        words = _words(table)
        return pd.Series([1 / (1 + np.exp(-words.logit(t))) for t in texts], dtype="float64")

    return scored(text)


def predictions(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Repeated rows stay; a null doc_id is
    not held out; labels and other columns are never inputs of the score."""
    made = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score(text_of(), fit(docs, labels, sample)).alias("score"))
    return made.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier gives label 1, columns as they came.

    Null and empty texts are scored too, repeated rows stay together, and an empty table gives an
    empty one; without a usable label every score is 0.5, so all stay."""
    name = unused(docs.columns, "score")
    return (docs.withColumn(name, score(text_of(), fit(docs, labels, sample)))
            .where(F.col(name) >= 0.5).drop(name))
