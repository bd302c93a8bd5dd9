"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct 32-bit hashes of its words, word pairs, and pairs with one
or two words between. Per-coordinate rates and an L1 term leave weights for a few thousand of them, which
go to every task.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import word_blocks
from weekloom.llm.labelled import at_most, held_out, labels_to_learn, sample_rows

#: Bounds of the fit: rows per class, and words of each (a piece at a place its hash chooses, if it has more).
FIT_ROWS, FIT_WORDS = 5000, 1000
EPOCHS, ALPHA, BETA, L1, L2 = 10, 1.0, 1.0, 2.0, 0.01
LEAST_DOCUMENTS = 3
THRESHOLD = 0.3
#: Distance of the words of a pair: neighbours and skips.
PAIRS = (1, 2, 3)
REMEMBERED = 500_000
_PUNCTUATION = string.punctuation.encode()
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_FILTER_BITS = 22


class _Words(dict):
    """Hash of each word without the punctuation around it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.strip(_PUNCTUATION))
        return value


_words = _Words()


def hashed_features(text: bytes) -> Iterator[np.ndarray]:
    """Hashes of the features of a text, block by block; they may repeat."""
    tail = np.zeros(0, np.uint64)
    for block in word_blocks(text.lower()):
        fresh = np.fromiter(map(_words.__getitem__, block), np.uint64, len(block))
        yield (fresh * _MIX[0] >> np.uint64(32)).astype(np.uint32)
        both = np.concatenate([tail, fresh])
        for gap in PAIRS:
            first = max(0, len(tail) - gap)
            a, b = both[first : len(both) - gap], both[first + gap :]
            yield ((a * _MIX[gap] + (b ^ _MIX[0])) * _MIX[0] >> np.uint64(32)).astype(np.uint32)
        tail = both[-max(PAIRS) :]


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted feature hashes with a weight, their weights, and the bias."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


class Scorer:
    """Scores of texts under a model, inside one task."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[model.keys >> np.uint32(32 - _FILTER_BITS)] = True

    def score(self, text: bytes) -> float:
        found = [f[self.seen[f >> np.uint32(32 - _FILTER_BITS)]] for f in hashed_features(text)]
        total = self.model.bias
        if found and len(self.model.keys):
            unique = np.unique(np.concatenate(found))
            at = np.minimum(np.searchsorted(self.model.keys, unique), len(self.model.keys) - 1)
            total += float(self.model.weights[at[self.model.keys[at] == unique]].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def ftrl(documents: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """(keys, weights, bias) from the distinct features of each document; only features of several documents count."""
    keys, counts = np.unique(np.concatenate(documents), return_counts=True)
    keys = keys[counts >= LEAST_DOCUMENTS]
    if not len(keys):
        return keys, np.zeros(0), 0.0
    rows = []
    for d in documents:
        at = np.minimum(np.searchsorted(keys, d), len(keys) - 1)
        rows.append(np.append(at[keys[at] == d] + 1, 0))  # 0: the bias
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    l1 = np.full(len(keys) + 1, L1)
    l1[0] = 0.0

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * l1[at] - z[at]
        return np.where(np.abs(z[at]) > l1[at], shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for at, y in zip(rows, labels):
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    w = weights(slice(None))
    kept = w[1:] != 0
    return keys[kept], w[1:][kept], float(w[0])


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit in one task on a bounded sample: ``FIT_ROWS`` rows of each class (of a repeated id too), ``FIT_WORDS`` words of each.

    The bias is moved to the true class sizes. Without any label the score is 0.5 everywhere; with
    one class only it is that class's smoothed share.
    """
    learn = labels_to_learn(labels, "toxic")
    sizes = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    nothing = ToxicityModel(np.zeros(0, np.uint32), np.zeros(0), prior)
    if len(sizes) < 2:
        return nothing

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data in batch.column(2):
                words = (data.as_py() or b"").split()
                start = xxhash.xxh64_intdigest(data.as_py() or b"") % max(1, len(words) - FIT_WORDS + 1)
                piece = b" ".join(words[start : start + FIT_WORDS])
                found.append(np.unique(np.concatenate([np.zeros(0, np.uint32), *hashed_features(piece)])).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], batch.schema.names)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = {(f, y) for b in batches for y, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
        rows = sorted(pairs, key=lambda r: (xxhash.xxh64_intdigest(r[0]), *r))  # copies teach once
        if not rows:
            return
        y = np.array([r[1] for r in rows], float)
        keys, weights, bias = ftrl([np.frombuffer(r[0], np.uint32) for r in rows], y)
        bias += prior - float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        out = [pa.array([*keys.astype(np.int64), -1], pa.int64()), pa.array([*weights, bias], pa.float64())]
        yield pa.RecordBatch.from_arrays(out, ["key", "weight"])

    sample = sample_rows(docs, learn, F.col("text").cast("binary"), FIT_ROWS, "toxicity").mapInArrow(features, "label int, place long, piece binary")
    sample = at_most(sample, FIT_ROWS).select("label", "piece").repartition(1)
    trained = sample.mapInArrow(train, "key long, weight double")
    found = {r["key"]: r["weight"] for r in trained.collect()}
    if not found:
        return nothing
    bias = found.pop(-1)
    keys = np.array(sorted(found), np.uint32)
    return ToxicityModel(keys, np.array([found[k] for k in keys.tolist()]), bias)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts have no features and get the bias. Repeated rows get equal scores; an empty table gives
    no rows; extra columns are ignored. Labels of null ids, null labels and ids without a document teach nothing.
    """
    model = fit(docs, labels)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = pa.array([scorer.score(x.as_py() or b"") for x in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    scored = read.mapInArrow(per_batch, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
