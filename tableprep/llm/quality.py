"""Quality by compression: a text that a dictionary of good texts shortens more than one of bad texts is likely good."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableprep.llm.batches import raw, slices
from tableprep.llm.components import stored

SAMPLE_PER_CLASS = 4000
SAMPLE_BYTES = 6 << 20
DICTIONARY_BYTES = 1 << 16
SAMPLE_BLOCK = 256
BLOCK = 1024
LEVEL = 3
_PLACES = 1 << 20


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary of about ``size`` bytes; where the samples are too few for training, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    plain = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(**plain)
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=loaded, **plain)


class Gauge:
    """The bytes a text saves with the good dictionary over the bad one, as a share of its length."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self._good, self._bad = _compressor(good).compress, _compressor(bad).compress

    def difference(self, data: bytes) -> float:
        """Between -1 and 1 or little beyond; 0 for an empty text. The text is taken in blocks of ``BLOCK`` bytes, each
        compressed on its own, so the dictionaries count for all of a long text and the room needed stays the same."""
        if not data:
            return 0.0
        whole = memoryview(data)
        saved = 0
        for start in range(0, len(data), BLOCK):
            block = whole[start:start + BLOCK]
            saved += len(self._bad(block)) - len(self._good(block))
        return saved / len(data)


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries, and the line that turns the difference into log odds."""

    good: bytes
    bad: bytes
    slope: float
    bias: float

    def gauge(self) -> Gauge:
        return Gauge(self.good, self.bad)


def calibrate(difference: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and constant of a weighted logistic regression by Newton's steps, with a weak prior on the slope (and towards
    labels smoothed by one row each), so that separable labels end too."""
    if not len(label):
        return 0.0, 0.0
    target = np.where(label == 1, (np.sum(label == 1) + 1) / (np.sum(label == 1) + 2), 1 / (np.sum(label == 0) + 2))
    scale = float(np.std(difference)) or 1.0
    x = np.stack([difference / scale, np.ones(len(difference))], axis=1)
    weight = weight * len(weight) / weight.sum()
    ridge = np.diag([1e-2, 1e-6])
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (weight * (target - p)) - ridge @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step * min(1.0, 4 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(beta[0])) / scale, float(beta[1])


def fit_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                label_column: str = "quality", sample_per_class: int = SAMPLE_PER_CLASS,
                sample_bytes: int = SAMPLE_BYTES) -> QualityModel:
    """A model from the rows of ``docs`` that ``labels`` marks 0 or 1; a null label or an id without one is left out.

    About ``sample_per_class`` ids of each class are drawn by their hash, all if there are fewer; a repeated id counts
    once, by its smallest text. Half of them give blocks for the class's dictionary, about ``sample_bytes`` in all; the
    other half calibrates the difference, weighted back to the share of the classes. Only the drawn ids are broadcast,
    and only those blocks and one number for each text reach the driver. With no labelled row, or one class alone,
    the model says that class's smoothed share for every text."""
    marked = labels.where(F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).alias("id")).agg(
        F.max(F.col(label_column).cast("int")).alias("label"))
    known = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("body"))
    present = stored(known.select("id").distinct().join(marked, "id"), "marked")
    totals = {row["label"]: row["count"] for row in present.groupBy("label").count().collect()}
    if len(totals) < 2:
        share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
        return QualityModel(b"", b"", 0.0, float(np.log(share / (1 - share))))

    def drawn(place: Column, share: dict[int, float]) -> Column:
        bound = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
        return F.pmod(place, F.lit(_PLACES)) < bound * _PLACES

    ids = present.where(drawn(F.xxhash64(F.col("id").cast("string")), {q: sample_per_class / totals[q] for q in totals}))
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("id").cast("string")), F.lit(2))
    texts = known.join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min("body").alias("body"))
    sample = stored(texts.select("label", part.alias("part"), "body"), "quality")
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.octet_length("body"), F.lit(1)) - 1) / SAMPLE_BLOCK))
    cut = F.transform(starts, lambda i: F.substring("body", (i * SAMPLE_BLOCK + 1).cast("int"), F.lit(SAMPLE_BLOCK)))
    blocks = sample.where("part = 0 and body is not null").select("label", F.posexplode(cut).alias("place", "block"))
    sizes = {row["label"]: row["size"] for row in blocks.groupBy("label").agg(F.sum(F.octet_length("block")).alias("size")).collect()}
    order = F.xxhash64("block", "place")
    few = blocks.where(drawn(order, {q: sample_bytes / max(1, sizes.get(q) or 0) for q in (0, 1)}))
    taken = few.orderBy("label", order, "block").select("label", "block").toArrow()
    pieces: dict[int, list[bytes]] = {0: [], 1: []}
    for label, block in zip(taken["label"].to_pylist(), taken["block"].to_pylist(), strict=True):
        pieces[label].append(block)
    model = QualityModel(build_dictionary(pieces[1]), build_dictionary(pieces[0]), 1.0, 0.0)
    rest = sample.where("part = 1")
    found = _differences(rest if not rest.isEmpty() else sample, model, "label", "body").toArrow()
    label = found["label"].to_numpy().astype(np.int64)
    rows = np.bincount(label, minlength=2)
    weight = np.array([totals[0] / max(1, rows[0]), totals[1] / max(1, rows[1])])[label]
    slope, bias = calibrate(found["difference"].to_numpy(), label, weight)
    return QualityModel(model.good, model.bad, slope, bias)


def _differences(docs: DataFrame, model: QualityModel, kept: str, text_column: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[kept], T.StructField("difference", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gauge = shared.value.gauge()
        for batch in slices(batches, text_column):
            found = [gauge.difference(data) for data in raw(batch.column(text_column))]
            yield pa.RecordBatch.from_arrays([batch.column(kept), pa.array(found, pa.float64())], names=schema.names)

    return docs.select(kept, text_column).mapInArrow(run, schema)


def score_quality(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``score`` (0 to 1) and ``difference`` for each row; null and empty texts have a difference of 0.
    Repeated rows stay, other columns are left out. Narrow; the dictionaries have a fixed size."""
    odds = F.col("difference") * F.lit(model.slope) + F.lit(model.bias)
    return _differences(docs, model, id_column, text_column).select(
        id_column, (1 / (1 + F.exp(-odds))).alias("score"), "difference")
