from __future__ import annotations

import random

from tests.llm import brute
from tests.llm.conftest import SF_DIR
from trendlake.llm import components, queries, simhash


def expected(rows):
    prints = [brute.fingerprint(t) for _, t in rows]
    groups = brute.linked_groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc, _), g in zip(rows, groups, strict=True):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return sorted(
        ((d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, groups, strict=True)), key=repr
    )


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.op5_simhash(spark, SF_DIR)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_messy(messy, messy_rows):
    got = simhash.near_duplicates(messy).select("doc_id", simhash.hex16(simhash.F.col("fp")), "component_id")
    assert sorted(map(tuple, got.collect()), key=repr) == expected([r[:2] for r in messy_rows])


def test_one_row_of_each_component_stays(messy, messy_rows):
    got = simhash.one_per_component(messy)
    assert got.columns == messy.columns
    kept = sorted((r.doc_id for r in got.collect()), key=repr)
    assert kept == sorted({c for *_, c in expected([r[:2] for r in messy_rows])}, key=repr)


def test_empty(no_documents):
    assert simhash.near_duplicates(no_documents).isEmpty()
    assert simhash.one_per_component(no_documents).isEmpty()


def test_dense_cluster_and_chains(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    values = {centre}
    for _ in range(300):
        value = centre
        for _ in range(rng.randint(1, 5)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    chain = rng.getrandbits(64)
    for i in range(20):
        chain ^= 3 << (3 * i)
        values.add(chain)
    values |= {rng.getrandbits(64) for _ in range(200)}
    values = sorted(values)
    groups = brute.linked_groups(values, lambda a, b: (a ^ b).bit_count() <= 2)
    prints = spark.createDataFrame([(i, simhash.signed(v)) for i, v in enumerate(values)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.component_ids(prints).collect()}
    assert [got[simhash.signed(v)] for v in values] == groups


def test_every_near_pair_shares_a_shard():
    masks = simhash.shard_masks()
    assert len(masks) == 15 and all(m.bit_count() >= 42 for m in masks)
    for i in range(64):
        for j in range(64):
            assert any(not m & (1 << i | 1 << j) for m in masks)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (130, 129)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 131)}
