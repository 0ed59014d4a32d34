from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from trendlake.llm import topk


def vectors(seed, n=400, size=6):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(size)]) for i in range(n)]
    hot = rows[7][1]
    rows += [(i, hot) for i in range(n, n + 150)]
    rows += [(2000, None), (2001, [1.0, None, *[0.0] * (size - 2)]), (2020, [math.nan] * size), (2040, [math.inf] * size)]
    rows += [(None, [1.0] * size), (3000, [1.0, 2.0]), (3020, [2.0, 2.0]), (3040, []), (3060, [0.0] * size)]
    rows += [rows[0], rows[20]]
    return rows


def expected(rows, k):
    clean = {
        (i, tuple(math.floor(64 * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, a in clean:
        if q % 20 == 0:
            found = sorted(
                (-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in clean if i != q and len(a) == len(b)
            )
            out += [(q, rank + 1, i, -score) for rank, (score, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("k,chunk_rows,block_rows", [(20, 50_000, 20_000), (5, 4, 30), (700, 50_000, 50)])
def test_exact(spark, monkeypatch, k, chunk_rows, block_rows):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    rows = vectors(k)
    df = spark.createDataFrame(rows, "id long, e array<double>").repartition(4)
    whole = df.select("id", topk.whole_numbers(F.col("e")).alias("v"))
    got = topk.top_k(whole, whole.where("id % 20 = 0"), k, chunk_rows)
    assert sorted(map(tuple, got.collect())) == expected(rows, k)


def test_large_components(spark):
    rows = [(i, [float(10**7 + i), float(10**7 - 3 * i)]) for i in range(60)]
    whole = spark.createDataFrame(rows, "id long, e array<double>").select("id", topk.whole_numbers(F.col("e")).alias("v"))
    got = topk.top_k(whole, whole.where("id % 20 = 0"), 5)
    assert sorted(map(tuple, got.collect())) == expected(rows, 5)


def test_empty(spark):
    none = spark.createDataFrame([], "id long, v array<bigint>")
    assert topk.top_k(none, none, 5).isEmpty()


def clusters(n=1200, size=8):
    rng = random.Random(5)
    middles = [[rng.gauss(0, 20) for _ in range(size)] for _ in range(6)]
    return [(i, [x + rng.gauss(0, 0.3) for x in middles[i % 6]]) for i in range(n)]


def test_clusters_visit_few_blocks(spark, monkeypatch):
    """Data go to the groups that need them only, and queries to the blocks their own bound reaches."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    sent = {"data": 0, "queries": 0}
    for name in sent:
        plain = getattr(topk, f"route_{name}")

        def counted(*args, plain=plain, name=name):
            frame = plain(*args)
            sent[name] += frame.count()
            return frame

        monkeypatch.setattr(topk, f"route_{name}", counted)
    rows = clusters()
    whole = spark.createDataFrame(rows, "id long, e array<double>").select(
        "id", topk.whole_numbers(F.col("e")).alias("v"), F.lit("x").alias("cell"), F.lit(0).alias("group")
    )
    got = topk.top_k(whole, whole.where("id % 20 = 0"), 7, chunk_rows=10)
    assert sorted(map(tuple, got.collect())) == expected(rows, 7)
    # All pairs would be 6 groups or more times 1200 rows, and 60 queries times 12 blocks or more, in each pass.
    assert sent["data"] < 2 * 1200 * 6 * 0.6
    assert sent["queries"] < 60 + 60 * 12 * 0.5


def test_bounds_hold():
    """No product exceeds the bound of its query or of its query's cell."""
    import numpy as np

    rng = np.random.default_rng(3)
    for scale in (1, 10**9):
        data = (rng.normal(size=(500, 5)) * 100 * scale + 30 * scale).astype(np.int64)
        cells = topk.Cells(data[:9].astype(float))
        cell, measures = cells.nearest(data)
        for c in range(9):
            own = {m: v[cell == c] for m, v in measures.items()}
            cells.rows[c] = int((cell == c).sum())
            cells.low[c], cells.high[c] = own["along"].min(), own["along"].max()
            cells.rest[c], cells.radius[c], cells.norm[c] = own["beside"].max(), own["apart"].max(), own["norm"].max()
        asked = (rng.normal(size=(80, 5)) * 100 * scale).astype(np.int64)
        asked_cell, asked_measures = cells.nearest(asked)
        radius = np.array([max(asked_measures["apart"][asked_cell == c], default=0) for c in range(9)])
        scores = topk.products(asked, data)
        for c in range(9):
            highest = scores[:, cell == c].max(1)
            assert (highest <= cells.bounds(asked.astype(float))[:, c]).all()
            assert (highest <= cells.group_bounds(radius)[asked_cell, c]).all()
