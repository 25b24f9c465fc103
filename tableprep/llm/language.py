"""Language ID by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes long. A byte seen after the longest context costs its share
there; else an escape is paid (method C: as many escapes as different bytes were seen) and the next shorter context
decides, down to a uniform guess over 256 bytes. The statistics are frozen after training, so what a text costs in a
language is an exact sum over its places, and the language of the shortest code wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableprep.llm.batches import raw, slices, text

UNDETERMINED = "und"
ORDER = 3
TRAINING_BYTES = 3_000_000
LETTER = re.compile(r"[^\W\d_]")


def _grams(data: bytes) -> np.ndarray:
    """At each byte, that byte and the three before it as one number; blanks stand before the text."""
    codes = np.frombuffer(b"   " + data, dtype=np.uint8).astype(np.uint32)
    return codes[:-3] << 24 | codes[1:-2] << 16 | codes[2:-1] << 8 | codes[3:]


def gram_counts(docs: DataFrame, group_column: str, text_column: str) -> DataFrame:
    """``group_column``, ``gram`` and ``n`` over all rows. Counted in each task first, so no group gathers anywhere."""
    schema = T.StructType([docs.schema[group_column], T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            of: dict = {}
            for group, data in zip(batch.column(group_column).to_pylist(), raw(batch.column(text_column)), strict=True):
                of.setdefault(group, []).append(_grams(data))
            for group, found in of.items():
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                groups = pa.array([group] * len(gram), batch.column(group_column).type)
                yield pa.RecordBatch.from_arrays(
                    [groups, pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], names=schema.names)

    counted = docs.select(group_column, text_column).mapInArrow(run, schema)
    return counted.groupBy(group_column, "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class ContextTrees:
    """Frozen costs in bits. ``known[k]`` sorts the strings of k + 1 bytes seen in any language; ``cost[k]`` has what
    their last byte costs after the others, a column for each language; the rest of a level is ``escape``: contexts of
    k bytes, sorted, and what leaving them costs."""

    languages: tuple[str, ...]
    known: tuple[np.ndarray, ...]
    cost: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    escape: tuple[np.ndarray, ...]

    @staticmethod
    def from_counts(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> ContextTrees:
        languages = tuple(sorted(counts))
        known, cost, contexts, escape = [], [], [], []
        for k in range(ORDER + 1):
            mask = (1 << 8 * (k + 1)) - 1
            level = [np.unique(counts[x][0] & mask, return_inverse=True) for x in languages]
            grams = np.unique(np.concatenate([one for one, _ in level])) if level else np.zeros(0, dtype=np.int64)
            before = np.unique(grams >> 8)
            leave = np.zeros((len(before), len(languages)))
            bits = np.full((len(grams), len(languages)), np.nan)
            for j, (language, (own, place)) in enumerate(zip(languages, level, strict=True)):
                n = np.bincount(place, weights=counts[language][1], minlength=len(own))
                context, at = np.unique(own >> 8, return_inverse=True)
                kinds, total = np.bincount(at), np.bincount(at, weights=n)
                leave[np.searchsorted(before, context), j] = np.log2((total + kinds) / kinds)
                bits[np.searchsorted(grams, own), j] = np.log2((total + kinds)[at] / n)
            shorter = (np.full((len(grams), len(languages)), 8.0) if k == 0
                       else _costs(grams, k - 1, known, cost, contexts, escape, len(languages)))
            left = leave[np.searchsorted(before, grams >> 8)] if len(grams) else leave
            known.append(grams)
            cost.append(np.where(np.isnan(bits), left + shorter, bits))
            contexts.append(before)
            escape.append(leave)
        return ContextTrees(languages, tuple(known), tuple(cost), tuple(contexts), tuple(escape))

    def bits(self, data: bytes, finder: Finder) -> np.ndarray:
        """What the whole text costs in each language."""
        if not data or not self.languages:
            return np.zeros(len(self.languages))
        grams = _grams(data)
        at = finder.find(grams)
        total = np.bincount(at, minlength=len(self.known[ORDER]) + 1) if len(at) > 4096 else None
        known = total[1:] @ finder.cost if total is not None else finder.padded[at].sum(axis=0, dtype=np.float64)
        missing = grams[at == 0].astype(np.int64)
        if len(missing):
            n = len(self.languages)
            known = known + _costs(missing, ORDER, self.known, self.cost, self.contexts, self.escape, n).sum(axis=0)
        return known


def _costs(grams: np.ndarray, k: int, known, cost, contexts, escape, n: int) -> np.ndarray:
    """Costs of last bytes after k bytes, for any grams: a level that knows the gram has it, else the escape from its
    context, if that was seen, is added to what the shorter context says."""
    if k < 0:
        return np.full((len(grams), n), 8.0)
    grams = grams & ((1 << 8 * (k + 1)) - 1)
    out = np.empty((len(grams), n))
    at = np.minimum(np.searchsorted(known[k], grams), max(len(known[k]) - 1, 0))
    here = known[k][at] == grams if len(known[k]) else np.zeros(len(grams), dtype=bool)
    out[here] = cost[k][at[here]]
    rest = grams[~here]
    if len(rest):
        left = np.zeros((len(rest), n))
        if len(contexts[k]):
            at = np.minimum(np.searchsorted(contexts[k], rest >> 8), len(contexts[k]) - 1)
            seen = contexts[k][at] == rest >> 8
            left[seen] = escape[k][at[seen]]
        out[~here] = left + _costs(rest, k - 1, known, cost, contexts, escape, n)
    return out


class Finder:
    """Places of grams among the known ones (from 1; 0: unknown) by two table look-ups: pairs of bytes get numbers, and
    pairs of pairs the place. Pairs that no known gram has share the number 0. Where that table would be large (more
    than ``MOST_CELLS``), sorted search finds the same."""

    MOST_CELLS = 1 << 25

    def __init__(self, trees: ContextTrees):
        self.grams = trees.known[ORDER]
        pairs = np.unique(np.concatenate([self.grams >> 16, self.grams & 0xFFFF]))
        self.pair = np.zeros(1 << 16, dtype=np.int32)
        self.pair[pairs] = np.arange(1, len(pairs) + 1)
        self.width = len(pairs) + 1
        self.place = None
        if self.width * self.width <= self.MOST_CELLS:
            self.place = np.zeros(self.width * self.width, dtype=np.int32)
            self.place[self._cell(self.grams)] = np.arange(1, len(self.grams) + 1)
        self.cost = trees.cost[ORDER]
        self.padded = np.vstack([np.zeros((1, len(trees.languages))), self.cost])

    def _cell(self, grams: np.ndarray) -> np.ndarray:
        return self.pair[grams >> 16] * self.width + self.pair[grams & 0xFFFF]

    def find(self, grams: np.ndarray) -> np.ndarray:
        if self.place is not None:
            return self.place[self._cell(grams)]
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.where(self.grams[at] == grams, at + 1, 0)


def fit_context_trees(docs: DataFrame, language: str = "lang", text_column: str = "text",
                      id_column: str = "doc_id", training_bytes: int = TRAINING_BYTES) -> ContextTrees:
    """Trees from labelled rows; rows without a language are left out.

    ``training_bytes`` bounds the sample: of each language, rows are drawn by a hash of their id so that about so many
    bytes of whole texts are expected, all if there are fewer. The counts of that sample are then exact."""
    labelled = docs.where(F.col(language).isNotNull()).select(
        F.col(language).alias("language"), F.col(text_column).alias("body"), F.col(id_column).alias("id"))
    size = F.sum(F.octet_length("body")).alias("size")
    sizes = {row["language"]: row["size"] or 0 for row in labelled.groupBy("language").agg(size).collect()}
    share = F.lit(0.0)
    for name, size in sizes.items():
        share = F.when(F.col("language") == name, F.lit(min(1.0, training_bytes / max(size, 1)))).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    drawn = labelled.where(place < share).select("language", "body")
    found = gram_counts(drawn, "language", "body").toPandas()
    counts = {name: (rows["gram"].to_numpy(dtype=np.int64), rows["n"].to_numpy(dtype=np.int64))
              for name, rows in found.groupby("language")}
    return ContextTrees.from_counts(counts)


def identify_language(docs: DataFrame, trees: ContextTrees, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """``id_column``, ``lang_pred``, ``score`` and ``bits_per_byte`` for each row of ``docs``.

    ``lang_pred`` is the language of the shortest code, the first by name among equals; ``und`` if the text is null,
    empty or without a letter, or if nothing was learned. ``score`` is that language's share of probability when each
    text of the codes' lengths is as likely, 0 for ``und``. ``bits_per_byte`` is the length of the best code (null for
    ``und``). Repeated rows stay; other columns are left out. Narrow; the trees are bounded by the training sample."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    schema = T.StructType([
        docs.schema[id_column], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        finder = Finder(model)
        for batch in slices(batches, text_column):
            names, scores, lengths = [], [], []
            for data in raw(batch.column(text_column)):
                if not model.languages or not LETTER.search(text(data)):
                    names.append(UNDETERMINED), scores.append(0.0), lengths.append(None)
                    continue
                bits = model.bits(data, finder)
                best = int(bits.argmin())
                names.append(model.languages[best])
                scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
                lengths.append(float(bits[best]) / len(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(lengths, pa.float64())], names=schema.names)

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def held_out(column: str, folds: int, fold: int) -> Column:
    """Whether the row is kept from training: crc32 of the id as text, modulo ``folds``, is ``fold``."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(0)) == fold
