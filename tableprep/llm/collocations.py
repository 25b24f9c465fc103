"""Phrases of a few words that recur, counted by bidirectional FM-indexes over word ids, one index per shard.

Each task turns its texts into shards, indexes them, extends intervals and sends every phrase it met with its count. The
shards cannot tell alone which phrases are rare, so all are sent, packed: a row for each shard and block of phrases, which
holds them in order of their words, compressed. A block takes the phrases whose hash says so, about as many at
any size of the corpus, sums them exactly and keeps those that reach the least count."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tableprep.llm.batches import raw
from tableprep.llm.components import stored

UNDETERMINED = "und"
END = 0
SHARD_WORDS = 1 << 19
BLOCK_TEXT_BYTES = 8 << 20
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TEXT_SLICE = 1 << 20
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + _PIECE_ENDS, bytes(range(97, 123)) + b" " + b"\n" * len(_PIECE_ENDS))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shard:
    """Word ids of some texts, ``END`` after each piece. The same word in two languages has two ids."""

    def __init__(self) -> None:
        self._next = count(1)
        self._ids: dict[str, defaultdict[bytes, int]] = {}
        self._parts: list[np.ndarray] = [np.array([END], dtype=np.int32)]
        self.size = 0

    def add(self, lang: str, data: bytes) -> None:
        ids = self._ids.get(lang)
        if ids is None:
            ids = self._ids[lang] = defaultdict(self._next.__next__, {b"": -1, b"\n": END})
        data = data.translate(_PLAIN)
        start = 0
        while start < len(data):
            end = len(data)
            if end - start > _TEXT_SLICE:  # cut at a space, so that no word is cut
                end = max(data.rfind(b" ", start, start + _TEXT_SLICE), start) + 1
                if end == start + 1:
                    end = data.find(b" ", start + _TEXT_SLICE) + 1 or len(data)
            tokens = data[start:end].replace(b"\n", b" \n ").split(b" ")
            part = np.fromiter(map(ids.__getitem__, tokens), np.int32, len(tokens))
            part = part[part >= 0]
            self._parts.append(part)
            self.size += len(part)
            start = end
        self._parts.append(np.array([END], dtype=np.int32))

    def close(self) -> Words:
        langs = sorted(self._ids)
        known = [(number, word, place) for number, lang in enumerate(langs) for word, place in self._ids[lang].items() if place > 0]
        known.sort()
        place = np.zeros(len(known) + 1, dtype=np.int32)
        place[[each[2] for each in known]] = np.arange(1, len(known) + 1)
        words = pa.array([b"", *[each[1] for each in known]], pa.binary())
        return Words(place[np.concatenate(self._parts)], words, np.array([0, *[each[0] for each in known]], dtype=np.int32), langs)


@dataclass(frozen=True)
class Words:
    """A closed shard: its ids; by id the word and the number of its language, in that order; the languages. Id 0 is
    ``END``."""

    ids: np.ndarray
    words: pa.Array
    owner: np.ndarray
    langs: list[str]

    def hashes(self) -> np.ndarray:
        """Of each word in its language, the same in every shard."""
        seeds = [xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) for lang in self.langs]
        pairs = zip(self.words.to_pylist(), self.owner.tolist(), strict=True)
        return np.array([xxhash.xxh64_intdigest(word, seeds[number]) for word, number in pairs], dtype=np.uint64)


def make_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Shards of about ``SHARD_WORDS`` words, or one text where that alone is longer, of rows of (lang, body)."""
    shard = Shard()
    for batch in batches:
        for lang, data in zip(batch.column("lang").to_pylist(), raw(batch.column("body")), strict=True):
            shard.add(lang, data)
            if shard.size >= SHARD_WORDS:
                yield shard.close()
                shard = Shard()
    if shard.size:
        yield shard.close()


@dataclass(frozen=True)
class Side:
    """One direction of the index: rows are the places of the text sorted by the words that start there, ``before`` is
    the word before each (the Burrows-Wheeler transform), ``ranks`` its occurrences as ``word * n + row`` in order."""

    before: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, depth: int) -> Side:
        """Rows are sorted by ``depth`` words, which is all that extending intervals up to that length needs."""
        n, sigma = len(ids), int(ids.max()) + 1
        following = [np.concatenate([ids[k:], np.zeros(k, ids.dtype)]) for k in range(depth)]
        if sigma ** depth < 1 << 63:
            key = following[0].astype(np.int64)
            for column in following[1:]:
                key *= sigma
                key += column
            rows = np.argsort(key)
        else:
            rows = np.lexsort(following[::-1])
        before = ids[rows - 1]
        return cls(before, np.sort(before.astype(np.int64) * n + np.arange(n)))

    def occurrences(self, word: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows before ``row`` that have ``word`` before them, plus all that have a smaller word."""
        return np.searchsorted(self.ranks, word.astype(np.int64) * len(self.before) + row)


@dataclass(frozen=True)
class Intervals:
    """Phrases (``words``: one array for each place) with their intervals in both directions, of equal ``size``."""

    words: tuple[np.ndarray, ...]
    forward: np.ndarray
    backward: np.ndarray
    size: np.ndarray

    def where(self, kept: np.ndarray) -> Intervals:
        return Intervals(tuple(w[kept] for w in self.words), self.forward[kept], self.backward[kept], self.size[kept])


class BidirectionalIndex:
    """Intervals of phrases can be extended by a word on either side; the other direction's interval follows."""

    def __init__(self, ids: np.ndarray, depth: int) -> None:
        self.sides = Side.of(ids, depth), Side.of(ids[::-1], depth)
        self.counts = np.bincount(ids)
        self.firsts = np.concatenate([[0], np.cumsum(self.counts)[:-1]])

    def single_words(self) -> Intervals:
        words = np.flatnonzero(self.counts)
        words = words[words != END]
        return Intervals((words,), self.firsts[words], self.firsts[words], self.counts[words])

    def _extended(self, side: Side, near: np.ndarray, far: np.ndarray, size: np.ndarray):
        """All words before the intervals ``near`` of ``side``: which interval, which word, the new near and far starts and
        the new size. The far interval is cut by words, in their order."""
        owner = np.repeat(np.arange(len(near)), size)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        sigma = len(self.counts)
        pairs = owner * sigma + side.before[near[owner] + within]
        pairs.sort()
        starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(pairs)))
        owner, word = pairs[starts] // sigma, pairs[starts] % sigma
        far = far[owner] + starts - (np.cumsum(size) - size)[owner]
        real = word != END
        owner, word, far, sizes = owner[real], word[real], far[real], sizes[real]
        return owner, word, side.occurrences(word, near[owner]), far, sizes

    def to_the_left(self, of: Intervals) -> Intervals:
        owner, word, forward, backward, size = self._extended(self.sides[0], of.forward, of.backward, of.size)
        return Intervals((word, *(w[owner] for w in of.words)), forward, backward, size)

    def to_the_right(self, of: Intervals) -> Intervals:
        owner, word, backward, forward, size = self._extended(self.sides[1], of.backward, of.forward, of.size)
        return Intervals((*(w[owner] for w in of.words), word), forward, backward, size)


def shard_phrases(ids: np.ndarray, longest: int) -> Iterator[Intervals]:
    """Words and phrases of up to ``longest`` words of one shard, by length. Pairs grow from words to the right, longer
    phrases from shorter ones to the left."""
    index = BidirectionalIndex(ids, longest)
    found = index.single_words()
    yield found
    for length in range(2, longest + 1):
        found = index.to_the_right(found) if length == 2 else index.to_the_left(found)
        yield found


PACKED = T.StructType([
    T.StructField("block", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("words", T.IntegerType()),
    *[T.StructField(name, T.BinaryType()) for name in ("phrases", "lengths", "times")]])
COUNTED = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("words", T.IntegerType()), T.StructField("phrase", T.BinaryType()),
    T.StructField("n", T.LongType())])


def _packed(shard: Words, found: Intervals, hashes: np.ndarray, blocks: int) -> Iterator[tuple]:
    """Rows of ``PACKED`` for the phrases of one length."""
    key = np.zeros(len(found.size), dtype=np.uint64)
    for word in found.words:
        key = (key ^ hashes[word]) * _MIX
        key ^= key >> np.uint64(29)
    part = (key % np.uint64(blocks)).astype(np.int64) * len(shard.langs) + shard.owner[found.words[0]]
    order = np.argsort(part, kind="stable")  # phrases of a part stay in order of their words
    part = part[order]
    phrases = pc.binary_join_element_wise(*[shard.words.take(pa.array(word[order])) for word in found.words], b" ")
    offsets = np.frombuffer(phrases.buffers()[1], np.int32, len(order) + 1)
    data, lengths, times = phrases.buffers()[2], np.diff(offsets), found.size[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
    press = zstandard.ZstdCompressor(level=1).compress
    for start, end in zip(cuts, [*cuts[1:], len(part)], strict=True):
        block, lang = divmod(int(part[start]), len(shard.langs))
        yield (block, shard.langs[lang], len(found.words), press(data[int(offsets[start]):int(offsets[end])]),
               press(lengths[start:end].astype(np.int32).tobytes()), press(times[start:end].astype(np.int64).tobytes()))


def phrase_counts(texts: DataFrame, least: int, longest: int) -> DataFrame:
    """lang, words, phrase and how often it occurs in all of ``texts`` (lang, body), for every phrase of up to ``longest``
    words that occurs ``least`` times or more; and with ``words`` 0 how many words the language has."""
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = int(size // BLOCK_TEXT_BYTES) + 1
    kinds = pa.schema([("block", pa.int32()), ("lang", pa.string()), ("words", pa.int32()),
                       *[(name, pa.binary()) for name in PACKED.names[3:]]])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds.types, strict=True)], schema=kinds)

        for shard in make_shards(batches):
            totals = np.bincount(shard.owner[shard.ids[shard.ids != END]], minlength=len(shard.langs))
            press = zstandard.ZstdCompressor(level=1).compress
            sums = [(0, shard.langs[i], 0, press(b""), press(np.int32(0).tobytes()), press(np.int64(totals[i]).tobytes()))
                    for i in np.flatnonzero(totals)]
            if sums:
                yield batch(sums)
            hashes = shard.hashes()
            for found in shard_phrases(shard.ids, longest):
                rows = list(_packed(shard, found, hashes, blocks))
                for start in range(0, len(rows), 1000):
                    yield batch(rows[start:start + 1000])

    def total(key: tuple, block: pa.Table) -> pa.Table:
        _, lang, words = (part.as_py() for part in key)
        loose = zstandard.ZstdDecompressor().decompress
        phrases, times = [], []
        for data, lengths, counts in zip(*[block[name].to_pylist() for name in PACKED.names[3:]], strict=True):
            offsets = np.concatenate([[0], np.cumsum(np.frombuffer(loose(lengths), np.int32))]).astype(np.int32)
            phrases.append(pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(loose(data))]))
            times.append(np.frombuffer(loose(counts), np.int64))
        met = pa.table({"phrase": pa.chunked_array(phrases), "n": np.concatenate(times)})
        summed = met.group_by("phrase").aggregate([("n", "sum")])
        summed = summed.filter(pc.greater_equal(summed["n_sum"], least if words else 0))
        many = len(summed)
        return pa.table({
            "lang": pa.array([lang] * many, pa.string()), "words": pa.array(np.full(many, words, np.int32)),
            "phrase": summed["phrase"], "n": summed["n_sum"]})

    sent = texts.mapInArrow(send, PACKED)
    return sent.groupBy("block", "lang", "words").applyInArrow(total, COUNTED).select(
        "lang", "words", F.col("phrase").cast("string").alias("phrase"), "n")


def _phrase(words: Column, start: int, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = 10, longest: int = 3,
                 covered_percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those at spaces and tabs into words. A
    phrase of 2 to ``longest`` words that occurs ``least`` times or more scores floor(1000000 a a / (l r)) at its weakest
    cut: a is its count, l and r those of the parts. It is left out if a longer one that holds it has at least
    ``covered_percent`` of its count. n counts the words of the language.

    Null texts count as empty, a null language as ``und``; empty tables give no row, repeated rows count again, other
    columns are left out, whatever their names. Ties in score go to the greater count, then the smaller phrase in byte
    order. Malformed UTF-8 passes as it is. A text of any length is indexed whole; a shard takes about half a million
    words, or one text. What meets in one task is a block of phrases, whose size does not follow the corpus, or what the
    tasks hold of a language's top."""
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(UNDETERMINED))
    texts = docs.select(lang.alias("lang"), F.col(text_column).cast("string").alias("body"))
    counts = stored(phrase_counts(texts, least, longest), "phrases")
    words = F.split("phrase", " ")
    frequent = counts.where((F.col("words") >= 2) & (F.col("n") >= least)).select(
        "lang", "phrase", "words", F.col("n").alias("a"))
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = frequent.select("*", cut).select(
        "*", _phrase(words, 1, F.col("k")).alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    parts = counts.where((F.col("words") >= 1) & (F.col("n") >= least)).select("lang", "phrase", "n")
    both = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # counts below 10 ** 15: all products fit decimals of 38 digits
    score = F.expr(
        "(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0)))"
        " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    weakest = both.select("lang", "phrase", "words", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    scored = weakest.groupBy("lang", "phrase", "words", "a").agg(F.min("cut").alias("cut")).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    inner = [
        F.when((F.col("words") > length) & (F.col("words") >= start + length - 1), _phrase(words, start, length))
        for length in range(2, longest) for start in range(1, longest - length + 2)]
    if inner:
        longer = frequent.where("words > 2").select("lang", "a", F.explode(F.array_compact(F.array(*inner))).alias("phrase"))
        most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        scored = scored.join(most, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
