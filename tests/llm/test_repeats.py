from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trendlake.llm import repeats


def run(docs, length=200):
    found = repeats.remove_repeats(docs, length=length)
    return found, sorted(
        map(
            tuple,
            found.select("n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect(),
        )
    )


@pytest.mark.parametrize("crowd", [0, 3, 1000])
def test_messy(messy, messy_rows, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    found, got = run(messy)
    assert found.columns == [c for c in messy.columns if c != "spans"] + ["n_bytes", "n_removed", "spans", "kept"]
    assert got == sorted(brute.without_repeats([r[1] for r in messy_rows], 200))


@pytest.mark.parametrize("seed", range(4))
def test_small_alphabet(spark, seed):
    # Few letters: many overlaps and nested repeats, within texts and across them.
    rng = random.Random(seed)
    base = ["".join(rng.choices("abc", k=160)) for _ in range(6)]
    texts = ["".join(rng.choices([*base, "x", "yz", ""], k=rng.randint(1, 9))) for _ in range(60)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    assert run(docs, 64)[1] == sorted(brute.without_repeats(texts, 64))


def test_shuffled_joins(spark, monkeypatch, messy, messy_rows):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", 0)
    assert run(messy)[1] == sorted(brute.without_repeats([r[1] for r in messy_rows], 200))


def test_stretches(monkeypatch):
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 101, 5000).astype(np.uint8)
    whole = repeats.anchors(raw, np.array([0, 2000, 5000]), 100)
    monkeypatch.setattr(repeats, "STRETCH", 777)
    cut = repeats.anchors(raw, np.array([0, 2000, 5000]), 100)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut, strict=True))


def test_intervals():
    assert sorted(repeats.intervals([0, 3, 1, 1, 0, 2])) == [(1, 0, 3), (2, 4, 5), (3, 0, 1)]
    assert list(repeats.intervals([0])) == []


def test_empty(no_documents):
    assert repeats.remove_repeats(no_documents).isEmpty()
