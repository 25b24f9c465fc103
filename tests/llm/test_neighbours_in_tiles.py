"""Queries and rows meet in tasks, not in the driver; what tiles, shards and bounds leave equals plain comparison."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprep.llm import ann


def plain(queries, rows, codes, k):
    """The k best of each query id by plain loops; ``queries`` and ``rows`` are lists of (id, vector)."""
    coded = [np.unpackbits(codes.of(v[None])[0]) for _, v in rows]
    best = {}
    for q in {i for i, _ in queries}:
        own = [v for i, v in queries if i == q]
        found = []
        for (i, v), code in zip(rows, coded, strict=True):
            if i != q and any((np.unpackbits(codes.of(w[None])[0]) != code).sum() <= codes.radius for w in own):
                found.append((min(float(np.sqrt(((v - w) ** 2).sum())) for w in own), i))
        best[q] = sorted(found)[:k]
    return best


@pytest.mark.parametrize("case", ["loose", "tight", "repeated", "ties", "lengths", "huge"])
def test_search_equals_plain_comparison(case):
    rng = np.random.default_rng(4)
    data, ids, radius = rng.normal(size=(900, 20)), np.arange(900), 9
    if case == "tight":
        data, radius = rng.normal(size=(30, 20))[rng.integers(0, 30, 900)] + 0.01 * data, 1
    elif case == "repeated":
        ids = rng.integers(0, 250, 900)
    elif case == "ties":
        data = rng.integers(-1, 2, size=(900, 20)).astype(float)
        data[rng.random(900) < 0.3] = 1
    elif case == "lengths":
        data *= np.exp(4 * rng.normal(size=(900, 1)))
    elif case == "huge":
        data *= 1e160
    codes = ann.Codes(20, np.zeros(20), np.linalg.qr(rng.normal(size=(24, 24)))[0][:20], radius)
    asks = np.flatnonzero(ids % 9 == 0)
    search, packed = ann.Search(5, codes.radius), codes.of(data)
    search.ask(ids[asks], data[asks], packed[asks])
    for start in range(0, 900, 90):
        search.meet(ids[start:start + 90], data[start:start + 90], packed[start:start + 90])
        if start % 270 == 0:
            search.search()  # a shard
    with np.errstate(over="ignore"):
        found = [tuple(r.values()) for batch in search.results(["q", "id", "score"]) for r in batch.to_pylist()]
        expected = plain([(ids[i], data[i]) for i in asks], list(zip(ids, data, strict=True)), codes, 5)
    assert [(q, i) for q, i, _ in found] == [(q, i) for q in sorted(expected) for _, i in expected[q]]
    assert [s for *_, s in found] == [pytest.approx(d) for q in sorted(expected) for d, _ in expected[q]]


def test_index_narrows_close_codes_only():
    codes = np.random.default_rng(5).integers(0, 256, size=(4_000, 8), dtype=np.uint8)
    assert ann.MultiIndex(codes, 3).narrows(codes[:50]) and not ann.MultiIndex(codes, 30).narrows(codes[:50])
    for radius in (3, 20):
        asked, found = ann.MultiIndex(codes, radius).within(codes[:50])
        apart = np.bitwise_count(codes[:50, None] ^ codes[None]).sum(axis=2)
        assert set(zip(asked.tolist(), found.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius)), strict=True))


def test_queries_do_not_pass_the_driver(spark, monkeypatch):
    plans = {}

    def spied(frame, label, stored=ann.stored):
        plans[label] = frame._jdf.queryExecution().executedPlan().toString()
        return stored(frame, label)

    data = np.random.default_rng(6).normal(size=(1_200, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    everything = sorted(map(tuple, ann.nearest_neighbours(frame, F.col("vec_id") % 10 == 0).collect()))
    monkeypatch.setattr(ann, "stored", spied)
    monkeypatch.setattr(ann, "SHARD", 64)  # 19 shards
    for name in ("ASKED_BYTES", "GROUP_BYTES"):
        monkeypatch.setattr(ann, name, 50 * 16 * 8, raising=False)  # several tiles
    tiled = sorted(map(tuple, ann.nearest_neighbours(frame, F.col("vec_id") % 10 == 0).collect()))
    # a copy of the queries for each shard, gathered for a broadcast, would fill the driver
    assert "Generate" in plans["nearest"] and "Broadcast" not in plans["nearest"] and "Join" not in plans["nearest"]
    assert len(tiled) == 1_200 and tiled == everything
