"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text becomes a sparse vector: shares of hashed words, and one bin each for
statistics of its structure and for numeric metadata. The score is
``b + w.x + 1/2 sum_f ((V_f.x)^2 - (V_f^2).(x^2))``: all pairwise interactions
in time linear in the vector's entries.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import bounded_batches
from tamiz.llm.labelled import log_odds_shift, training_rows

WORD_BUCKETS = 1 << 13
FACTORS = 8
BINS = 16
STATISTICS = 8
SAMPLE = 3000
EPOCHS = 8
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>!?{}[]\\/=+_~^@"


class WordBuckets(dict):
    """Bucket of a word, hashed once; starts anew beyond a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = bucket = zlib.crc32(word) % WORD_BUCKETS
        return bucket


def _bin(value: float) -> int:
    return min(BINS - 2, int(value * (BINS - 1)))


def _log_bin(value: float | None) -> int:
    """Bin of a non-negative number by its logarithm; the last bin is for a missing one."""
    if value is None or value != value:
        return BINS - 1
    return min(BINS - 2, int(abs(value) + 1).bit_length() * 2 // 3)


def features(data: bytes, metadata: Sequence, buckets: WordBuckets) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of one whole text."""
    words = data.split()
    n, size = len(words), max(1, len(data))
    repeated = sum(map(operator.eq, words, words[1:]))
    inner = sum(map(len, words))
    shares = (
        (size - len(data.translate(None, UPPER))) / size if data else 0.0,
        (size - len(data.translate(None, SYMBOLS))) * 4 / size if data else 0.0,
        (size - len(data.translate(None, DIGITS))) * 4 / size if data else 0.0,
        len(set(words)) / n if n else 0.0,
        repeated / n if n else 0.0,
        inner / n / 20 if n else 0.0,
    )
    bins = [_bin(min(1.0, s)) for s in shares] + [_log_bin(n), _log_bin(data.count(b"\n"))]
    bins += [_log_bin(m) for m in metadata]
    one_hot = WORD_BUCKETS + np.arange(len(bins)) * BINS + np.array(bins)
    counts = np.bincount(np.fromiter(map(buckets.__getitem__, words), np.int64, n), minlength=WORD_BUCKETS)
    present = np.flatnonzero(counts)
    share = np.sqrt(counts[present] / max(1, n))
    return np.concatenate((present, one_hot)), np.concatenate((share, np.ones(len(bins))))


class FactorisationMachine:
    """bias, linear weights ``w`` and factors ``v`` (one row per feature)."""

    def __init__(self, size: int, seed: int = 1):
        self.bias, self.w = 0.0, np.zeros(size)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (size, FACTORS))

    def logit(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.v[index]
        total = value @ v
        return self.bias + value @ self.w[index] + 0.5 * float(total @ total - (value**2) @ (v**2).sum(axis=1))

    def probability(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(index, value), -30, 30))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 2):
        """Logistic loss, AdaGrad over batches; each class weighs as often as it occurs in ``rows``."""
        if not len(rows):
            return self
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.bias = float(np.log(share / (1 - share)))
        if labels.min() == labels.max():
            return self
        rng = np.random.default_rng(seed)
        seen_w, seen_v, rate, decay = np.full_like(self.w, 1e-2), np.full_like(self.v, 1e-2), 0.1, 1e-4
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 32)):
                index = np.concatenate([rows[i][0] for i in batch])
                x = np.concatenate([rows[i][1] for i in batch])
                starts = np.concatenate(([0], np.cumsum([len(rows[i][0]) for i in batch])[:-1]))
                row = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
                v = self.v[index]
                xv = x[:, None] * v
                total = np.add.reduceat(xv, starts)
                pairs = 0.5 * ((total**2).sum(1) - np.add.reduceat((xv**2).sum(1), starts))
                z = self.bias + np.add.reduceat(x * self.w[index], starts) + pairs
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) / len(batch)
                e = error[row] * x
                touched, inverse = np.unique(index, return_inverse=True)
                gw = np.bincount(inverse, e) + decay * self.w[touched]
                gv = np.zeros((len(touched), FACTORS))
                np.add.at(gv, inverse, e[:, None] * (total[row] - xv))
                gv += decay * self.v[touched]
                seen_w[touched] += gw**2
                seen_v[touched] += gv**2
                self.w[touched] -= rate * gw / np.sqrt(seen_w[touched])
                self.v[touched] -= rate * gv / np.sqrt(seen_v[touched])
                self.bias -= rate * float(error.sum())
        return self


def _each(texts: pa.Array, metadata: Sequence[pa.Array]):
    buckets = WordBuckets()
    columns = [m.to_pylist() for m in metadata]
    for i, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        yield features(text or b"", [c[i] for c in columns], buckets)


def fit(
    docs: DataFrame, labels: DataFrame, metadata: Sequence[str] = (), bound: int = SAMPLE, doc_id: str = "doc_id", text: str = "text"
) -> FactorisationMachine:
    """Learns from at most ``bound`` documents of each label; features are made where the texts are.

    The bias is moved to the shares of the labels among all documents to learn
    from, so scores do not shift where the bound cuts one label more.
    Without labels every score is 0.5; with labels of one kind it is near that label.
    """
    model = FactorisationMachine(WORD_BUCKETS + BINS * (STATISTICS + len(metadata)))
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
    rows = training_rows(docs, known, "quality", bound, doc_id=doc_id, columns=(text, *metadata))

    @F.arrow_udf("struct<index:array<int>,value:array<float>>")
    def sparse(texts: pa.Array, *numbers: pa.Array) -> pa.Array:
        return pa.array([{"index": i, "value": x} for i, x in _each(texts, numbers)], sparse_type)

    sparse_type = pa.struct([("index", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))])
    vector = sparse(F.col(f"`{text}`"), *[F.col(f"`{m}`").cast("double") for m in metadata])
    sample = sorted(rows.select("doc_id", "label", vector.alias("x")).collect(), key=lambda r: r["doc_id"])
    vectors = [(np.array(r["x"]["index"]), np.array(r["x"]["value"])) for r in sample]
    model.fit(vectors, np.array([r["label"] for r in sample], float))
    model.bias += log_odds_shift(docs, known, "quality", bound, doc_id)
    return model


def with_score(
    docs: DataFrame, model: FactorisationMachine, metadata: Sequence[str] = (), text: str = "text", name: str = "score"
) -> DataFrame:
    """``docs`` with the probability of label 1 (double) of every whole text.

    Null and empty texts are scored by their statistics alone; missing
    metadata has a bin of its own. Equal texts with equal metadata get equal
    scores. ``name`` must be new.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array, *numbers: pa.Array) -> pa.Array:
        return pa.array([model.probability(i, x) for i, x in _each(texts, numbers)], pa.float64())

    bounded_batches(docs)
    return docs.withColumn(name, score(F.col(f"`{text}`"), *[F.col(f"`{m}`").cast("double") for m in metadata]))
