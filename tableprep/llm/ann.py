"""Nearest neighbours by multi-index hashing.

Vectors get binary codes: centred, turned by a rotation learned so that the signs lose least, and cut at zero. A code is
split into substrings of eight bits, and each substring has an index of its own. Codes within Hamming radius r of a
query agree with it up to floor(r / substrings) bits in at least one substring, so probing every index for the values
that near finds all of them; what is found is ranked by the original vectors.

Queries and rows travel packed, some thousands in a row of Spark, and meet in tiles: a block of queries and a group of
rows, one task each. A task holds its queries with their best so far and takes the rows as they come, a shard at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tableprep.llm.components import stored

SAMPLE = 8192
SAMPLE_QUERIES = 512
CATCH = 0.985
SHARD = 8192
QUERY_BLOCK = 256
TURNS = 30
PACKED = ["block", "place", "n", "ids", "vectors", "codes"]
#: Bytes of the vectors in a packed row, of a tile's queries and of a tile's rows.
PACK_BYTES, ASKED_BYTES, GROUP_BYTES = 4 << 20, 64 << 20, 64 << 20
#: Probes that meet a larger share of a shard's rows than this cost more than comparing codes one by one.
PROBED = 1 / 16
#: Blocks of queries between two merges, rows in a product, pairs ranked at once.
BLOCKS_AT_ONCE, COLUMNS, PAIRS = 4, 2048, 16384
TINY = 1e-35


@dataclass(frozen=True)
class Codes:
    """``centre``, and ``turn`` that takes centred vectors to code bits (a multiple of 8 of them); ``radius``: what the
    codes of true neighbours in the sample differed in, for a share of ``CATCH``."""

    dimensions: int
    centre: np.ndarray
    turn: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """A row of bytes for each vector."""
        return np.packbits((vectors - self.centre) @ self.turn > 0, axis=1)


def learn_codes(sample: np.ndarray, bits: int | None = None, k: int = 10, catch: float = CATCH) -> Codes:
    """Rotation by alternating: bits for the present rotation, then the rotation that fits those bits best."""
    dimensions = sample.shape[1]
    bits = bits or max(8, dimensions // 8 * 8)
    centre = sample.mean(axis=0) if len(sample) else np.zeros(dimensions)
    centred = sample - centre
    axes = np.linalg.svd(centred.T @ centred)[0][:, :min(bits, dimensions)] if len(sample) else np.eye(dimensions)[:, :bits]
    flat = np.random.default_rng(7).normal(size=(bits, bits))
    rotation = np.linalg.qr(flat)[0][:axes.shape[1]]
    flat_sample = centred @ axes
    for _ in range(TURNS if len(sample) else 0):
        signs = np.where(flat_sample @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(flat_sample.T @ signs, full_matrices=False)
        rotation = left @ right
    codes = Codes(dimensions, centre, axes @ rotation, bits)
    packed, apart = codes.of(sample), []
    square = (sample * sample).sum(axis=1)
    for i in range(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES)):
        distance = square - 2 * sample @ sample[i]
        distance[i] = np.inf
        near = np.argpartition(distance, min(k, len(sample) - 1))[:k]
        apart += np.bitwise_count(packed[near[near != i]] ^ packed[i]).sum(axis=1).tolist()
    radius = int(np.quantile(apart, catch, method="higher")) if apart else bits
    return Codes(dimensions, centre, axes @ rotation, radius)


class MultiIndex:
    """Substring indexes over the codes of one shard of rows."""

    def __init__(self, packed: np.ndarray, radius: int):
        self.packed, self.radius, self.words = packed, radius, _words(packed)
        self.rows = [np.argsort(packed[:, j], kind="stable") for j in range(packed.shape[1])]
        self.starts = [np.searchsorted(packed[rows, j], np.arange(257)) for j, rows in enumerate(self.rows)]
        values = np.arange(256, dtype=np.uint8)
        self.near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius // packed.shape[1]
        self.reach = [self.near @ np.diff(starts) for starts in self.starts]

    def narrows(self, codes: np.ndarray) -> bool:
        """Whether probes for these codes meet few enough rows to be worth it."""
        return sum(int(reach[codes[:, j]].sum()) for j, reach in enumerate(self.reach)) <= PROBED * len(codes) * len(self.packed)

    def within(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``codes`` and rows: every pair that differs in at most ``radius`` bits, found by probes."""
        hit = np.zeros((len(codes), len(self.packed)), dtype=bool)
        for j, (rows, starts) in enumerate(zip(self.rows, self.starts, strict=True)):
            asked, probes = np.nonzero(self.near[codes[:, j]])
            first, n = starts[probes], starts[probes + 1] - starts[probes]
            hit[np.repeat(asked, n), rows[_runs(first, n)]] = True
        asked, found = np.divmod(_set(hit.ravel()), len(self.packed))
        fits = self.fit(_words(codes)[asked], found)
        return asked[fits], found[fits]

    def fit(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Which of the pairs differ in at most ``radius`` bits."""
        return np.bitwise_count(words ^ self.words[rows]).sum(axis=1, dtype=np.int64) <= self.radius

    def fitting(self, words: np.ndarray, width: int) -> np.ndarray:
        """The same for each of the codes and each of the first ``width`` rows."""
        apart = np.zeros((len(words), width), dtype=np.int16)
        for j in range(words.shape[1]):
            apart += np.bitwise_count(words[:, j, None] ^ self.words[None, :width, j])
        return apart <= self.radius


def _words(packed: np.ndarray) -> np.ndarray:
    """Codes as 64-bit words, filled up with zeros."""
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def _set(flags: np.ndarray) -> np.ndarray:
    """Places of the few that are true."""
    whole = len(flags) // 8 * 8
    eight = np.flatnonzero(flags[:whole].view(np.uint64) != 0)
    places = (eight[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([places[flags[places]], whole + np.flatnonzero(flags[whole:])])


def _runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of all runs of length ``n`` from ``first``, one run after the other."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Search:
    """The queries of a tile with their ``k`` best of the rows met so far.

    Rows that can't come among the best are left out by distances from a matrix product, whose rounding is allowed for:
    ``q.x - |x|^2 / 2`` falls as the distance grows, and what is computed is raised by ``slack`` times the squared lengths.
    What is left is tested by code and ranked by distances in doubles."""

    def __init__(self, k: int, radius: int):
        self.k, self.radius = k, radius
        self.asked: list = []
        self.waiting: list = []
        self.vectors = None

    def ask(self, ids: np.ndarray, vectors: np.ndarray, packed: np.ndarray) -> None:
        self.asked.append((ids, vectors, packed))

    def meet(self, ids: np.ndarray, vectors: np.ndarray, packed: np.ndarray) -> None:
        if self.waiting and sum(len(w[0]) for w in self.waiting) + len(ids) > SHARD:
            self.search()
        self.waiting.append((ids, vectors, packed))

    def ready(self) -> None:
        ids, vectors, packed = (np.concatenate(x) for x in zip(*self.asked, strict=True))
        self.asked, order = [], np.argsort(ids, kind="stable")
        ids, self.vectors, self.packed = ids[order], vectors[order], packed[order]
        self.words = _words(self.packed)
        self.first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        self.ids, self.n = ids[self.first], np.diff([*self.first, len(ids)])
        self.owner = np.repeat(np.arange(len(self.ids)), self.n)
        self.most = float(np.abs(self.vectors).max())
        self.square = np.einsum("ij,ij->i", self.vectors, self.vectors, dtype=np.float64)
        self.lifted, self.room = {}, {}
        self.best = np.full((len(self.ids), self.k), np.inf)
        self.best_ids = np.zeros((len(self.ids), self.k), dtype=ids.dtype)
        self.found = np.zeros(len(self.ids), dtype=np.int64)

    def search(self) -> None:
        """The waiting rows, as one shard, for all queries."""
        if not self.asked and self.vectors is None:
            self.waiting = []
            return
        if self.vectors is None:
            self.ready()
        ids, vectors, packed = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        self.waiting = []
        shard = Shard(ids, vectors, MultiIndex(packed, self.radius), max(self.most, float(np.abs(vectors).max())))
        block = self.first // (QUERY_BLOCK * BLOCKS_AT_ONCE)  # the vectors of an id stay together
        cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
        for start, end in zip([0, *cuts], [*cuts, len(self.ids)], strict=True):
            self.search_block(start, end, shard)

    def search_block(self, start: int, end: int, shard: Shard) -> None:
        """For the ids from place ``start`` to ``end``."""
        first, last = int(self.first[start]), int(self.first[end - 1] + self.n[end - 1])
        owners, rows = [], []
        for at in range(first, last, QUERY_BLOCK):
            part = slice(at, min(last, at + QUERY_BLOCK))
            asked, found = shard.index.within(self.packed[part]) if shard.index.narrows(self.packed[part]) else self.close(part, shard)
            owners.append(self.owner[at + asked]), rows.append(found)
        owners, rows = np.concatenate(owners), np.concatenate(rows)
        if last - first > end - start:  # several vectors of an id may have found a row
            pairs = np.unique(owners * len(shard.ids) + rows)
            owners, rows = np.divmod(pairs, len(shard.ids))
        other = shard.ids[rows] != self.ids[owners]
        owners, rows = owners[other], rows[other]
        lot = np.cumsum(self.n[owners]) // PAIRS
        cuts = np.flatnonzero(lot[1:] != lot[:-1]) + 1
        kept = [self.ranked(owners[a:b], rows[a:b], shard) for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True) if b > a]
        if kept:
            self.take(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    def close(self, part: slice, shard: Shard) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that the bounds leave, those of codes too far apart among them, for queries that the index does not narrow."""
        kind, owner, rows = shard.kind, self.owner[part], len(shard.ids)
        if kind is None:
            return np.divmod(np.arange(len(owner) * rows), rows)
        if kind not in self.lifted:
            self.room[kind] = np.empty(QUERY_BLOCK * COLUMNS, kind)
            self.lifted[kind] = np.concatenate([self.vectors.astype(kind), np.ones((len(self.vectors), 1), dtype=kind)], axis=1)
        lifted, room = self.lifted[kind][part], shard.slack * self.square[part] + TINY
        bound = np.where(self.found[owner] == self.k, self.best[owner, self.k - 1], np.inf)
        free = np.flatnonzero(~np.isfinite(bound))
        bound[free] = 0
        low = (self.square[part] - bound ** 2) / 2 - room
        low[free] = -np.inf
        for width in dict.fromkeys((min(COLUMNS, rows), rows)):  # without k so far, the k best of these rows set the bound
            open_ = free[np.isneginf(low[free])]
            if len(open_) and width >= self.k:
                fits = shard.index.fitting(self.words[part][open_], width)
                for i, name in enumerate(self.ids[owner[open_]]):
                    own = shard.places(name)
                    fits[i, own[own < width]] = False
                lower = np.where(fits, lifted[open_] @ shard.lifted[:width].T - shard.gap[:width], -np.inf)
                low[open_] = np.partition(lower, width - self.k, axis=1)[:, width - self.k] - 2 * room[open_]
        low = np.nextafter(low.astype(kind), kind(-np.inf))[:, None]
        asked, found = [], []
        for at in range(0, rows, COLUMNS):
            width = min(COLUMNS, rows - at)
            score = self.room[kind][:len(owner) * width].reshape(len(owner), width)  # fresh memory would cost more than the product
            np.matmul(lifted, shard.lifted[at:at + width].T, out=score)
            near = _set((score >= low).ravel())
            asked.append(near // width), found.append(at + near % width)
        return np.concatenate(asked), np.concatenate(found)

    def ranked(self, owners: np.ndarray, rows: np.ndarray, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs with a code within the radius: the id's place, the row's id and the least distance."""
        n = self.n[owners]
        several, of, starts = len(n) < n.sum(), _runs(self.first[owners], n), np.cumsum(n) - n
        fits = shard.index.fit(self.words[of], np.repeat(rows, n))
        if several:
            fits = np.logical_or.reduceat(fits, starts)
        owners, rows, n = owners[fits], rows[fits], n[fits]
        apart = shard.vectors[np.repeat(rows, n)].astype(np.float64) - self.vectors[_runs(self.first[owners], n)]
        distance = np.sqrt((apart ** 2).sum(axis=1))
        if several and len(n):
            distance = np.minimum.reduceat(distance, np.cumsum(n) - n)
        return owners, shard.ids[rows], distance

    def take(self, owners: np.ndarray, ids: np.ndarray, distance: np.ndarray) -> None:
        """Merges pairs with the best so far."""
        held = np.unique(owners)
        places, ranks = np.nonzero(np.arange(self.k) < self.found[held][:, None])
        owners = np.concatenate([held[places], owners])
        ids = np.concatenate([self.best_ids[held[places], ranks], ids])
        distance = np.concatenate([self.best[held[places], ranks], distance])
        order = np.lexsort((ids, distance, owners))
        owners, ids, distance = owners[order], ids[order], distance[order]
        begins = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]]))
        n = np.diff([*begins, len(owners)])
        rank = np.arange(len(owners)) - np.repeat(begins, n)
        kept = rank < self.k
        self.best[owners[kept], rank[kept]], self.best_ids[owners[kept], rank[kept]] = distance[kept], ids[kept]
        self.found[held] = np.minimum(n, self.k)

    def results(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            self.search()
        for start in range(0, len(self.found) if self.vectors is not None else 0, SHARD):
            places, ranks = np.nonzero(np.arange(self.k) < self.found[start:start + SHARD, None])
            places += start
            columns = self.ids[places], self.best_ids[places, ranks], self.best[places, ranks]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)


class Shard:
    """Rows of a tile with their index, and what bounds need. ``kind``: the floats in which products do not overflow."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, index: MultiIndex, most: float):
        self.ids, self.vectors, self.index = ids, vectors, index
        self.order = np.argsort(ids, kind="stable")
        size = np.float64(most) ** 2 * (vectors.shape[1] + 1) if most < 1e150 else np.inf
        self.kind = np.float32 if size < 1e36 else np.float64 if size < 1e300 else None
        if self.kind is None:
            return
        self.slack = (vectors.shape[1] + 8) * float(np.finfo(self.kind).eps) + 1e-13
        square = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
        self.lifted = np.concatenate([vectors.astype(self.kind), ((1.5 * self.slack - 0.5) * square).astype(self.kind)[:, None]], axis=1)
        self.gap = (3 * self.slack * square).astype(self.kind)

    def places(self, name: np.generic) -> np.ndarray:
        """Rows of an id."""
        start, end = (np.searchsorted(self.ids, name, side, self.order) for side in ("left", "right"))
        return self.order[start:end]


def _packer(codes: Codes, kind: type):
    """For ``mapInArrow``: rows of ``block``, ``id`` and ``v`` packed by block, ``place`` counting the packed rows of a task
    from its number on."""
    most = max(1, min(SHARD, PACK_BYTES // (codes.dimensions * np.dtype(kind).itemsize)))

    def packed(block: int, place: int, ids: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
        coded = codes.of(vectors.astype(np.float64))
        columns = [pa.array([block], pa.int32()), pa.array([place], pa.int64()), pa.array([len(ids)], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([np.ascontiguousarray(vectors, dtype=kind).tobytes()], pa.binary()), pa.array([coded.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            vectors = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, codes.dimensions)
            for block in np.unique(blocks).tolist():
                rows = np.flatnonzero(blocks == block)
                old_ids, old = held.pop(block, (None, None))
                ids, own = batch.column("id").take(pa.array(rows)), vectors[rows]
                if old is not None:
                    ids, own = pa.concat_arrays([old_ids, ids]), np.concatenate([old, own])
                while len(ids) >= most:
                    yield packed(block, place, ids.slice(0, most), own[:most])
                    place, ids, own = place + 1, ids.slice(most), own[most:]
                if len(ids):
                    held[block] = ids, own
        for block, (ids, own) in held.items():
            yield packed(block, place, ids, own)
            place += 1

    return run


def usable(vector: str, dimensions: int | None = None) -> Column:
    """Not null or zero, nothing null or non-finite inside, and of the given length."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0)
    return F.coalesce(kept & (F.size(vector) == dimensions if dimensions else F.lit(True)), F.lit(False))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)


def fit_codes(vectors: DataFrame, id_column: str, vector_column: str, bits: int | None = None) -> Codes | None:
    """Codes learned from ``SAMPLE`` vectors, those of smallest hash of id and vector. The commonest length (of equally
    common ones the larger) is that of the index. None where no vector is usable."""
    fine = vectors.where(usable(vector_column))
    common = fine.groupBy(F.size(vector_column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    drawn = fine.where(F.size(vector_column) == common["d"]).select(F.col(vector_column).cast("array<double>").alias("v"),
        F.xxhash64(id_column, vector_column).alias("h")).orderBy("h").limit(SAMPLE).toArrow()
    column = drawn["v"].combine_chunks()
    return learn_codes(_matrix(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column, common["d"]), bits)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id",
                       vector_column: str = "embedding", codes: Codes | None = None) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``id_column`` and ``score`` (Euclidean distance in doubles): the ``k`` nearest
    found for each row that ``is_query`` marks, nearest first, ties by smaller id; a row is no candidate of its own id.

    Vectors that are null, zero, of another length than most, or hold null or non-finite values take no part. Rows are
    dealt over groups, queries over blocks; each group meets each block in one task, which takes the rows in shards of about
    ``SHARD``, each with its indexes, and returns the ``k`` best of the group. Neither queries nor rows pass the driver, and
    queries are copied once for each group, rows once for each block. Queries that find fewer than ``k`` within the radius are
    compared with all rows in a second pass of the same form. Repeated rows are candidates as often as they stand there, but
    ask once. An id with several different vectors asks with all of them, and a row's distance is that from the nearest of
    them: the id gets ``k`` rows in all, each once. An empty table gives no rows."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_column].dataType
    codes = codes or fit_codes(vectors, id_column, vector_column)
    out = T.StructType([T.StructField("query_id", id_type), T.StructField(id_column, id_type), T.StructField("score", T.DoubleType())])
    ranked = T.StructType([out[0], T.StructField("rank", T.IntegerType()), *out[1:]])
    if codes is None:
        return spark.createDataFrame([], ranked)
    dimensions = codes.dimensions
    single = isinstance(vectors.schema[vector_column].dataType.elementType, T.FloatType)
    kind = np.float32 if single else np.float64
    fine = vectors.where(usable(vector_column, dimensions) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(vector_column).cast("array<float>" if single else "array<double>").alias("v"),
        is_query.alias("asks"))
    pack = _packer(codes, kind)
    types = T.IntegerType(), T.LongType(), T.LongType(), T.ArrayType(id_type), T.BinaryType(), T.BinaryType()
    packed = T.StructType([T.StructField(*field) for field in zip(PACKED, types, strict=True)])
    rows = stored(fine.select(F.lit(0).alias("block"), "id", "v").mapInArrow(pack, packed), "shards")
    n = rows.agg(F.sum("n")).first()[0] or 0
    size = dimensions * np.dtype(kind).itemsize
    groups = max(1, min(-(-n // SHARD), max(-(-n * size // GROUP_BYTES), 2 * spark.sparkContext.defaultParallelism)))
    asking = stored(fine.where("asks").select("id", "v").distinct(), "asking")
    blocks = max(1, -(-asking.count() * size // ASKED_BYTES))
    queries = asking.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "v")

    def searched(queries: DataFrame, radius: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, search = None, None
            for batch in batches:
                for i in range(batch.num_rows):
                    tile = batch.column("tile")[i].as_py()
                    if tile != last:
                        if search:
                            yield from search.results(out.names)
                        last, search = tile, Search(k, radius)
                    ids = batch.column("ids")[i].values.to_numpy().copy()
                    own = np.frombuffer(batch.column("vectors")[i].as_buffer(), kind).reshape(-1, dimensions).copy()
                    coded = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint8).reshape(len(ids), -1).copy()
                    (search.meet if batch.column("met")[i].as_py() else search.ask)(ids, own, coded)
            if search:
                yield from search.results(out.names)

        def dealt(frame: DataFrame, block: Column, group: Column, met: bool) -> DataFrame:
            return frame.select((block * F.lit(groups) + group).cast("int").alias("tile"), F.lit(met).alias("met"), "ids", "vectors", "codes")

        def each(count: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

        group = F.pmod(F.col("place"), F.lit(groups))
        asked = dealt(queries.mapInArrow(pack, packed).withColumn("group", each(groups)), F.col("block"), F.col("group"), False)
        tiles = asked.unionByName(dealt(rows.withColumn("block", each(blocks)), F.col("block"), group, True))
        tiles = tiles.repartitionById(blocks * groups, "tile").sortWithinPartitions("tile", "met")
        best = tiles.mapInArrow(run, out)
        order = Window.partitionBy("query_id").orderBy("score", id_column)
        return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*ranked.names)

    first = stored(searched(queries, codes.radius), "nearest")
    full = first.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
    short = stored(queries.join(full, F.col("id") == F.col("query_id"), "left_anti"), "short")
    if short.isEmpty():
        return first
    again = stored(searched(short, 8 * len(codes.of(np.zeros((1, dimensions)))[0])), "again")
    asked = again.select(F.col("query_id").alias("asked_again")).distinct()
    return first.join(asked, F.col("query_id") == F.col("asked_again"), "left_anti").unionByName(again)
