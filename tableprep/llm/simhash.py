"""SimHash fingerprints and their exact neighbours, compared tile by tile.

A tile holds up to ``TILE`` different fingerprints that have the same numbers of set bits in each of their four 16-bit
quarters. Fingerprints within the radius differ in those four numbers by no more than the radius in all, so tile pairs
beyond that are never made. The others are compared whole with exclusive-or and bit counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableprep.llm.batches import raw, slices
from tableprep.llm.components import connected_components, stored

SEED = 42
WORDS = 3
RADIUS = 2
TILE = 4096
QUARTERS = 4


def fingerprint_of(data: bytes, words: int = WORDS) -> int:
    """64 bits: bit i is set if it is set in over half of the shingles' hashes."""
    tokens = data.lower().split()  # of bytes: A-Z, and the blanks \\x20 and \\x09-\\x0D
    if not tokens:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return hashed(b" ".join(tokens), SEED)
    runs = zip(*(tokens[i:] for i in range(words)), strict=False)
    hashes = np.fromiter((hashed(b" ".join(run), SEED) for run in runs), dtype=np.uint64, count=len(tokens) - words + 1)
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start:start + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * votes > len(hashes))
    return int((np.uint64(1) << set_bits.astype(np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 words: int = WORDS) -> DataFrame:
    """``id`` and ``code`` (the 64 bits as a bigint) for each row. Null and empty texts have code 0."""
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), T.StructField("code", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            codes = np.array([fingerprint_of(data, words) for data in raw(batch.column(text_column))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(id_column), pa.array(codes.view(np.int64))], names=["id", "code"])

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def _quarter_counts() -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned("code", 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(QUARTERS)]


def near_keys(radius: int) -> list[tuple[int, int]]:
    """Differences of packed tile keys to look at. Of two opposite ones the positive is enough: a tile pair is
    unordered."""
    found = []
    for steps in product(range(-radius, radius + 1), repeat=QUARTERS):
        packed = sum(step << 5 * q for q, step in enumerate(steps))
        if sum(map(abs, steps)) <= radius and packed >= 0:
            found.append(packed)
    return sorted(found)


def spanning_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all pairs within the radius, links that join the same groups: fewer than there are codes. Done in strips, so
    that memory stays bounded."""
    group = np.arange(len(left) + len(right))
    ends_a, ends_b = [], []
    strip = max(1, (1 << 21) // max(1, len(right)))
    for start in range(0, len(left), strip):
        near = np.bitwise_count(left[start:start + strip, None] ^ right[None, :]) <= radius
        for i in np.flatnonzero(near.any(axis=1)):
            place, hits = start + int(i), np.flatnonzero(near[i])
            while len(hits := hits[group[len(left) + hits] != group[place]]):
                if left[place] != right[hits[0]]:
                    ends_a.append(left[place]), ends_b.append(right[hits[0]])
                group[group == group[len(left) + hits[0]]] = group[place]
    return np.array(ends_a, dtype=np.uint64).view(np.int64), np.array(ends_b, dtype=np.uint64).view(np.int64)


def code_links(codes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a`` and ``b``: links between different codes that connect all those within the radius. ``codes`` has a column
    ``code`` without repeats.

    Tiles are dealt by key and number, hot keys over as many tiles as they need, and each tile pair is one row of a
    join on both. The counts per key that are broadcast have at most 17^4 rows."""
    keyed = codes.select("code", sum((c.cast("long") * (1 << 5 * q) for q, c in enumerate(_quarter_counts())), F.lit(0)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / F.lit(float(tile))).cast("int").alias("tiles"))
    tiles = stored(
        keyed.join(F.broadcast(sizes), "key")
        .withColumn("number", F.pmod(F.xxhash64("code", F.lit(1)), F.col("tiles")).cast("int"))
        .groupBy("key", "number").agg(F.collect_list("code").alias("codes")), "tiles")
    sizes = stored(sizes, "sizes")
    steps = F.array(*[F.lit(step).cast("long") for step in near_keys(radius)])
    probes = (
        tiles.select(F.col("key").alias("own"), F.col("number").alias("own_number"), F.col("codes").alias("probe"),
                     F.explode(steps).alias("step"))
        .withColumn("key", F.col("own") + F.col("step")).join(F.broadcast(sizes), "key")
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .where("step > 0 or number >= own_number").select("key", "number", "probe")
    )
    pairs = probes.join(tiles, ["key", "number"]).select("probe", "codes")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            for probe, codes in zip(batch.column("probe"), batch.column("codes"), strict=True):
                a, b = spanning_links(probe.values.to_numpy().view(np.uint64), codes.values.to_numpy().view(np.uint64), radius)
                if len(a):
                    found_a.append(a), found_b.append(b)
            if found_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], names=["a", "b"])

    return pairs.mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS,
                    radius: int = RADIUS) -> DataFrame:
    """``id_column``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` for each row of ``docs``.

    Rows whose codes differ in at most ``radius`` bits are linked, and ``component_id`` is the smallest id reachable
    over links; equal codes are one node of the graph, so copies never meet as pairs. Texts that are null, empty or
    without a word have code 0 and are linked like any other. Null ids take part; they are never the smallest unless
    alone. Repeated rows stay, other columns are left out, an empty table gives no rows."""
    spark = docs.sparkSession
    hashed = stored(fingerprints(docs, id_column, text_column, words), "codes")
    nodes = stored(hashed.groupBy("code").agg(F.min("id").alias("least")), "nodes")
    member = connected_components(spark, code_links(nodes.select("code"), radius)).withColumnRenamed("node", "code")
    grouped = nodes.join(member, "code")
    smallest = grouped.groupBy("root").agg(F.min("least").alias("joined"))
    joined = grouped.join(smallest, "root").select("code", "joined")
    reached = nodes.join(joined, "code", "left").select("code", F.coalesce("joined", "least").alias("component_id"))
    return hashed.join(stored(reached, "reached"), "code").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
