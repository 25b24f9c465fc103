"""Toxicity by a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tableprep.llm.batches import lists, raw, slices
from tableprep.llm.components import stored

SIZES = (3, 4, 5)
BITS = 18
SAMPLE_PER_CLASS = 3000
SMOOTHING = 1.0
LEAST_SIGNAL = 2.5
DECAY = 1e-4
ROUNDS = 120
PIECE = 1 << 16
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def features(data: bytes, place: np.ndarray) -> np.ndarray:
    """The different n-grams of a text as bucket numbers; A-Z count as a-z. ``place`` is scratch room of ``2 ** BITS``.
    Long texts are taken in overlapping pieces, so the room needed does not grow with the text."""
    codes = b" " + data.lower() + b" "
    if len(codes) <= PIECE:
        return _buckets(codes, place)
    seen = np.zeros(1 << BITS, dtype=bool)
    for start in range(0, len(codes), PIECE):
        seen[_buckets(codes[start:start + PIECE + max(SIZES) - 1], place)] = True
    return np.flatnonzero(seen)


def _buckets(text: bytes, place: np.ndarray) -> np.ndarray:
    codes = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    found, gram = [], codes
    for size in range(2, max(SIZES) + 1):
        gram = gram[:-1] << np.uint64(8) | codes[size - 1:]
        if size in SIZES and len(gram):
            found.append((gram * _MULTIPLIERS[SIZES.index(size)]) >> np.uint64(64 - BITS))
    if not found:
        return np.zeros(0, dtype=np.int64)
    buckets = np.concatenate(found).astype(np.int64)
    order = np.arange(len(buckets))
    place[buckets] = order
    return buckets[place[buckets] == order]


@dataclass(frozen=True)
class ToxicityModel:
    """Weights for buckets (ratio times learned coefficient) and a constant."""

    weights: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray) -> float:
        z = self.bias + float(self.weights[buckets].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log of the smoothed shares of a bucket among toxic and among clean texts' features."""
    p, q = toxic + smoothing, clean + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def fit_linear(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, ratios: np.ndarray,
               used: np.ndarray) -> ToxicityModel:
    """Logistic regression on the scaled features of the buckets ``used``, by full-batch steps of adaptive size from
    zero: the same every time."""
    cut = [row[used[row]] for row in rows]
    lengths = np.array([len(row) for row in cut])
    flat = np.concatenate(cut) if cut else np.zeros(0, dtype=np.int64)
    buckets, column = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), lengths)
    scale = ratios[buckets]
    value = scale[column]
    w, b, seen = np.zeros(len(buckets)), 0.0, np.full(len(buckets) + 1, 1e-8)
    weights = weights / weights.sum()
    for step in range(ROUNDS):
        z = np.bincount(owner, weights=w[column] * value, minlength=len(rows)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) * weights
        gradient = np.append(np.bincount(column, weights=error[owner] * value, minlength=len(buckets)) + DECAY * w, error.sum())
        seen += gradient * gradient
        move = 0.1 * gradient / np.sqrt(seen)
        w -= move[:-1]
        b -= move[-1]
    out = np.zeros(1 << BITS, dtype=np.float64)
    out[buckets] = w * scale
    return ToxicityModel(out, float(b))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 label_column: str = "toxic", sample_per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """A model from the rows of ``docs`` that ``labels`` marks 0 or 1; a null label or an id without one is left out.

    About ``sample_per_class`` ids of each class are drawn by their hash, all if there are fewer, and weighted back to
    the share of their class; a repeated id counts once, by its smallest text. The drawn ids, which that parameter
    bounds, are what is broadcast: no text outside the sample is shuffled. The counts behind the ratios are made by
    Spark over the sample. With no labelled row, or one class alone, the model says that class's smoothed share for
    every text."""
    marked = labels.where(F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).alias("label"))
    known = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("body"))
    present = stored(known.select("id").distinct().join(marked, "id"), "marked")
    totals = {row["label"]: row["count"] for row in present.groupBy("label").count().collect()}
    if len(totals) < 2:
        share = (totals.get(1, 0) + 1) / (sum(totals.values()) + 2)
        return ToxicityModel(np.zeros(1 << BITS), float(np.log(share / (1 - share))))
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    share = F.when(F.col("label") == 1, min(1.0, sample_per_class / totals[1])).otherwise(min(1.0, sample_per_class / totals[0]))
    drawn = known.join(F.broadcast(present.where(place < share)), "id").groupBy("id", "label").agg(F.min("body").alias("body"))
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("buckets", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = np.zeros(1 << BITS, dtype=np.int64)
        for batch in slices(batches, "body", 1 << 20):
            found = [features(data, room) for data in raw(batch.column("body"))]
            values = np.concatenate(found).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), lists(values, [len(x) for x in found])], names=schema.names)

    sample = stored(drawn.select("body", F.col("label").cast("int").alias("label")).mapInArrow(run, schema), "toxic")
    per_bucket = sample.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).toPandas()
    counts = np.zeros((2, 1 << BITS))
    counts[0, per_bucket["bucket"]], counts[1, per_bucket["bucket"]] = per_bucket["toxic"], per_bucket["clean"]
    ratios = log_count_ratios(counts[0], counts[1])
    # a ratio that is within a few standard errors of nothing is noise
    signal = np.abs(ratios) / np.sqrt(1 / (counts[0] + SMOOTHING) + 1 / (counts[1] + SMOOTHING))
    used = signal >= LEAST_SIGNAL

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row[used[row]] for row in batch.column("buckets").to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), lists(np.concatenate([np.zeros(0, dtype=np.int32), *found]), [len(x) for x in found])],
                names=schema.names)

    table = sample.mapInArrow(cut, schema).orderBy("label", F.xxhash64("buckets")).toArrow()
    marks = table["label"].to_numpy().astype(np.int64)
    column = table["buckets"].combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    flat, cuts = column.values.to_numpy().astype(np.int64), column.offsets.to_numpy()
    rows = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    weight = np.array([totals[0] / max(1, (marks == 0).sum()), totals[1] / max(1, (marks == 1).sum())])
    return fit_linear(rows, marks, weight[marks], ratios, used)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column`` and ``score`` (0 to 1) for each row; null and empty texts are scored as a text without a word.
    Repeated rows stay, other columns are left out. Narrow; the weights have a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[id_column], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = np.zeros(1 << BITS, dtype=np.int64)
        for batch in slices(batches, text_column):
            scores = [shared.value.score(features(data, room)) for data in raw(batch.column(text_column))]
            yield pa.RecordBatch.from_arrays([batch.column(id_column), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)
