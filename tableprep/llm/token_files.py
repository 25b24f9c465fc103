"""Token ids in files of directly addressable codes.

A file holds whole documents, ids in levels of one byte: the lowest byte of every id; the next byte of those that need
one; and so on. A bitmap beside each level says which ids go on, and a directory of counts says where in the next level.
Any id is read by itself from a few places of the file; nothing is decoded block by block.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tableprep.llm.batches import raw, slices

MAGIC = b"DAC1"
HEADER = struct.Struct("<4sIIIQI")  # magic, part, number in the part, documents, ids, levels
BLOCK = 512
IDS_PER_FILE = 1 << 22
MOST_WORDS = 200_000
MOST_PIECES = 300_000


def pack(doc_ids: list, counts: list[int], ids: np.ndarray, part: int = 0, number: int = 0) -> bytes:
    """One file: header, documents (id, whether it has one, count of ids), then the levels."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK // 8)))
        blocks = np.bitwise_count(bitmap).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
        before = np.cumsum(blocks, dtype=np.uint32) - blocks
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bitmap.tobytes()
                      + before.astype("<u4").tobytes())
        rest = rest[more] >> 8
    known = np.array([x is not None for x in doc_ids], dtype=np.uint8)
    named = np.array([x or 0 for x in doc_ids], dtype="<i8")
    head = HEADER.pack(MAGIC, part, number, len(doc_ids), len(ids), len(levels))
    return head + named.tobytes() + known.tobytes() + np.array(counts, dtype="<u4").tobytes() + b"".join(levels)


class TokenFile:
    """Reads one file's bytes."""

    def __init__(self, data: bytes):
        magic, self.part, self.number, documents, self.n_ids, levels = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += found.nbytes
            return found

        named, known = take("<i8", documents), take("u1", documents)
        self.doc_ids = [int(x) if k else None for x, k in zip(named, known, strict=True)]
        self.counts = take("<u4", documents).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.levels = []
        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-n // BLOCK)
            self.levels.append((take("u1", n), take("u1", blocks * BLOCK // 8), take("<u4", blocks)))

    def get(self, i: int) -> int:
        """The id at place ``i`` of the file."""
        value = 0
        for depth, (chunks, bitmap, before) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * depth
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            whole = bitmap[block * BLOCK // 8:i >> 3]
            part = int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(before[block]) + int(np.bitwise_count(whole).sum()) + part.bit_count()
        return value

    def ids(self) -> np.ndarray:
        """All ids."""
        out, going = np.zeros(self.n_ids, dtype=np.uint32), np.arange(self.n_ids)
        for depth, (chunks, bitmap, _) in enumerate(self.levels):
            out[going] |= chunks.astype(np.uint32) << np.uint32(8 * depth)
            going = going[np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)]
        return out


#: Fixed patterns: what is no word of plain Latin letters and ASCII signs, and how the tokenizer cuts them once their letters are
#: small ones.
NOT_PLAIN = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<\|")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\x09-\x0D\x20a-z0-9ß-öø-ÿ]+")
WORD_END = "</w>"
LOT = 200


class _Words:
    """Packed ids of words met before (``known``); when there are too many, only those met again stay.

    The tokenizer drops white space and never looks across it, so words between blanks can be encoded one by one. Plain
    words are put together from ``pieces``, which repeat more often than words do and are encoded many at a time; the
    ids that end a piece say where to cut. Other words, and those that may hold a special token, go to the tokenizer
    whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # pieces are cut and in small letters already
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _whole(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(one.ids, dtype=np.uint32).tobytes() for one in found]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        ids = np.array(self.plain.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(cuts) != len(pieces):  # a vocabulary without marks of word ends
            return self._whole(pieces)
        packed = ids.tobytes()
        return [packed[start:end] for start, end in zip([0, *cuts], cuts, strict=False)]

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > MOST_WORDS:
            self.older, self.known, new = self.known, {}, words
        kept = [word for word in new if word in self.older]
        self.known.update(zip(kept, map(self.older.__getitem__, kept), strict=True))
        if len(self.pieces) > MOST_PIECES:
            self.pieces.clear()
        rest = list(new.difference(kept))
        if not rest:
            return
        # all words at once: none holds a line feed
        together = b"\n".join(rest).decode("utf-8", "replace")
        lowered = together.lower().split("\n")
        if NOT_PLAIN.search(together):
            strings = together.split("\n")
            is_plain = [NOT_PLAIN.search(string) is None for string in strings]
            others = list(compress(rest, map(not_, is_plain)))
            self.known.update(zip(others, self._whole(list(compress(strings, map(not_, is_plain)))), strict=True))
            rest, lowered = list(compress(rest, is_plain)), list(compress(lowered, is_plain))
        cuts = [[word] if word.isalpha() else PIECES.findall(word) for word in lowered]
        unknown = list(set(chain.from_iterable(cuts)).difference(self.pieces))
        for first in range(0, len(unknown), LOT):
            lot = unknown[first:first + LOT]
            self.pieces.update(zip(lot, self._joined(lot), strict=True))
        ids = self.pieces.__getitem__
        self.known.update(zip(rest, [ids(one[0]) if len(one) == 1 else b"".join(map(ids, one)) for one in cuts], strict=True))


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_column: str = "doc_id",
                      text_column: str = "text", ids_per_file: int = IDS_PER_FILE) -> None:
    """Encodes every text, adds ``end_id``, and writes files below ``path`` in ascending order of ``id_column``: rows
    without an id first, equal ids by text. A file takes documents until it has ``ids_per_file`` ids; a longer document
    fills one by itself. Null and empty texts have the end id alone, repeated rows stay, an empty table writes no file.

    Texts are shuffled once, by ranges of the id. Spark commits the files, so a lost task leaves none behind."""
    ordered = docs.select(id_column, text_column).repartitionByRange(F.col(id_column).asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col(id_column).asc_nulls_first(), text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, number = _words(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=np.uint32).tobytes()
        held: tuple[list, list[int], list[bytes]] = ([], [], [])
        size = 0

        def file() -> pa.RecordBatch:
            doc_ids, counts, packed = held
            data = pack(doc_ids, counts, np.frombuffer(b"".join(packed), dtype=np.uint32), part, number)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["file"])

        for batch in slices(batches, text_column, 1 << 20):
            split = [data.split() for data in raw(batch.column(text_column))]
            words.learn(set(chain.from_iterable(split)))
            for doc_id, one in zip(batch.column(id_column).to_pylist(), split, strict=True):
                ids = b"".join([*map(words.known.__getitem__, one), end])
                if held[0] and size + len(ids) // 4 > ids_per_file:
                    yield file()
                    held, size, number = ([], [], []), 0, number + 1
                held[0].append(doc_id), held[1].append(len(ids) // 4), held[2].append(ids)
                size += len(ids) // 4
        if held[0]:
            yield file()

    files = ordered.mapInArrow(run, T.StructType([T.StructField("file", T.BinaryType())]))
    # the text writer puts out the bytes as they are, and a line feed that readers skip
    files.select(F.col("file").cast("string")).write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document: ``part``, ``number`` and ``row`` (its file and its place there), ``doc_id``, ``before``
    (ids of the file before it), ``n_ids``, and ``ids`` as little-endian unsigned 32-bit integers."""
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("number", T.LongType()), T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()), T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in raw(batch.column("content")):
                file = TokenFile(data)
                ids, lot = file.ids(), 2000
                for first in range(0, len(file.doc_ids), lot):
                    docs = range(first, min(first + lot, len(file.doc_ids)))
                    n = len(docs)
                    cut = [ids[file.starts[d]:file.starts[d] + file.counts[d]].astype("<u4").tobytes() for d in docs]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([file.part] * n, pa.int64()), pa.array([file.number] * n, pa.int64()),
                        pa.array(docs, pa.int64()), pa.array(file.doc_ids[first:first + n], pa.int64()),
                        pa.array(file.starts[first:first + n]), pa.array(file.counts[first:first + n]),
                        pa.array(cut, pa.binary())], names=schema.names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, schema)


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: how many ids all documents before this one have. ``rows`` are those of ``read_token_files``;
    what is gathered is one row per file, and per part."""
    files = rows.groupBy("part", "number").agg(F.sum("n_ids").alias("held"))
    parts = files.groupBy("part").agg(F.sum("held").alias("part_held"))
    before = F.coalesce(F.sum("part_held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("part_before"))
    within = F.coalesce(F.sum("held").over(
        Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = files.withColumn("file_before", within).join(parts, "part").select(
        "part", "number", (F.col("part_before") + F.col("file_before")).alias("offset"))
    return rows.join(offsets, ["part", "number"]).withColumn("start", F.col("offset") + F.col("before")).drop("offset")
