"""Quality by compression: which dictionary, of good or of bad text, fits a document better.

Two zstandard dictionaries are built from labelled text. Every whole text is compressed with both,
in blocks, so that a long text meets the dictionaries in each of its parts. The normalised size
difference and the size relative to the text feed a logistic calibration on other labelled rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.labelled import at_most, held_out, labels_to_learn, sample_rows

#: Bounds of the fit: rows per class and step, and characters that one sampled text gives to a dictionary.
DICTIONARY_ROWS, CALIBRATION_ROWS, SAMPLE_BYTES = 3000, 4000, 4096
DICTIONARY_BYTES, BLOCK, LEVEL, EVIDENCE = 1 << 17, 4096, 3, 400
THRESHOLD = 0.7


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries (bytes, may be empty) and calibration weights; small enough to send with each task."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    #: False where no text of both classes was seen, so the score is the same guess for every text.
    learnt: bool = True


def _piece() -> Column:
    """The text; of a longer one a piece, at a place its hash chooses."""
    text = F.coalesce(F.col("text"), F.lit(""))
    room = F.greatest(F.length(text) - SAMPLE_BYTES, F.lit(0)) + 1
    return F.encode(F.substring(text, F.pmod(F.xxhash64(text), room).cast("int") + 1, F.lit(SAMPLE_BYTES)), "utf-8")


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the joined texts where there are too few to train one."""
    texts = [t for t in texts if t]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[:DICTIONARY_BYTES]


class Compressor:
    """Sizes under both dictionaries, for use inside one task."""

    def __init__(self, model: QualityModel):
        self.weights = np.array(model.weights)
        self.sides = [
            zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(d) if d else None,
                compression_params=zstandard.ZstdCompressionParameters.from_level(
                    LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
                ),
            )
            for d in (model.good, model.bad)
        ]

    def features(self, text: bytes) -> tuple[float, float, float, float]:
        """1, and by the weight of the evidence: 1, normalised size difference, size relative to the text.

        The weight grows from 0 to 1 with the length, so that a short text stays near the share of good rows.
        """
        good = bad = 0
        for i in range(0, len(text), BLOCK):
            block = text[i : i + BLOCK]
            good += len(self.sides[0].compress(block))
            bad += len(self.sides[1].compress(block))
        if not text:
            return (1.0, 0.0, 0.0, 0.0)
        weight = len(text) / (len(text) + EVIDENCE)
        return (1.0, weight, weight * 10.0 * (bad - good) / (bad + good), weight * good / len(text))

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights @ np.array(self.features(text)), -30, 30))))


def _features(rows: DataFrame, model: QualityModel) -> DataFrame:
    """(label, place, piece) for rows (label, place, piece of text): the piece becomes its features, as eight-byte numbers."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = Compressor(model)
        for batch in batches:
            found = [np.array(compressor.features(x.as_py() or b"")).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], batch.schema.names)

    return rows.mapInArrow(per_batch, "label int, place long, piece binary")


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic weights by Newton steps; both classes at their own frequency."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on a bounded sample of labelled rows: ``DICTIONARY_ROWS`` per class for the dictionaries,
    ``CALIBRATION_ROWS`` per class, other rows, for the calibration (weighted to the true class sizes). Rows of a
    repeated id count one by one, so the bounds hold for it too.

    Without any label the score is 0.5 everywhere; with one class only it is that class's smoothed share.
    """
    learn = labels_to_learn(labels, "quality")
    sizes = {r["label"]: r["count"] for r in learn.groupBy("label").count().collect()}
    if len(sizes) < 2:
        n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
        return QualityModel(b"", b"", (float(np.log((n1 + 1) / (n0 + 1))), 0.0, 0.0, 0.0), False)
    part = F.crc32(F.concat(F.lit("part"), F.col("doc_id").cast("string")).cast("binary")) % 2
    texts = {0: [], 1: []}
    chosen = sample_rows(docs, learn.where(part == 0), _piece(), DICTIONARY_ROWS, "dictionary")
    for row in at_most(chosen, DICTIONARY_ROWS).collect():
        texts[row["label"]].append(bytes(row["piece"]))
    good, bad = (_dictionary(sorted(texts[k], key=zlib.crc32)) for k in (1, 0))
    chosen = sample_rows(docs, learn.where(part == 1), F.col("text").cast("binary"), CALIBRATION_ROWS, "calibration")
    rows = at_most(_features(chosen, QualityModel(good, bad, (0.0,) * 4)), CALIBRATION_ROWS).collect()
    if not rows:
        both = bool(good and bad)
        return QualityModel(good, bad, (float(np.log((sizes[1] + 1) / (sizes[0] + 1))), 0.0, 1.0, 0.0), both)
    x, y = np.array([np.frombuffer(r["piece"]) for r in rows]), np.array([r["label"] for r in rows], float)
    order = np.lexsort((*x.T, y))
    weights = np.array(_calibrate(x[order], y[order]))
    shown = (y.sum() + 1) / (len(y) - y.sum() + 1)
    both = bool(good and bad) or 0 < y.sum() < len(y)
    weights[0] += np.log((sizes[1] + 1) / (sizes[0] + 1) / shown)
    return QualityModel(good, bad, tuple(float(v) for v in weights), both)


def score(docs: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``score`` (0 to 1, higher: better) for every row; null texts count as empty."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = Compressor(model)
        for batch in batches:
            found = pa.array([compressor.score(x.as_py() or b"") for x in batch.column(0)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], [*batch.schema.names[1:], "score"])

    read = docs.select(F.col("text").cast("binary").alias("data"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[1:])
    return read.mapInArrow(per_batch, f"{kinds}, score double")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Repeated rows get equal scores; an empty table gives no rows. Extra columns are ignored. Labels
    of null ids, null labels and ids without a document teach nothing.
    """
    scored = score(docs, fit(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    Where nothing could be learnt, as labels are missing or only one class of them has texts, all rows stay.
    """
    model = fit(docs, labels)
    if not model.learnt:
        return docs
    packed = docs.select(F.struct("*").alias("row"), "text")
    return score(packed, model, ["row"]).where(F.col("score") >= THRESHOLD).select("row.*")
