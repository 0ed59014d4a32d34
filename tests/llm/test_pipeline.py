from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.compare import spark_result, sql_result
from tests.llm import brute
from tests.llm.conftest import SF_DIR
from tests.llm.test_packing import plain_ids
from trendlake.llm import queries
from trendlake.shared import materialize


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert spark_result(queries.QUERIES[name](spark, SF_DIR)) == sql_result(SF_DIR, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_covers_every_document(spark, name):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    got = queries.QUERIES[name](spark, SF_DIR)
    if name != "op3_license_scan":
        assert got.select("doc_id").distinct().count() == documents


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "pii", "mixing", "packing"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF_DIR), name))
    raw, good, alone, private, mixed, packed = ([r for r in t.collect()] for t in tables)
    assert all(t.columns == docs.columns for t in tables[:-1])

    kept = {r.doc_id for r in queries.op1_quality_rules(spark, SF_DIR).where("kept").collect()}
    assert sorted(good) == sorted(r for r in raw if r.doc_id in kept)

    prints = [brute.fingerprint(r.text) for r in good]
    groups = brute.linked_groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r, g in zip(good, groups, strict=True):
        least[g] = min(r.doc_id, least.get(g, r.doc_id))
    assert sorted(r.doc_id for r in alone) == sorted(least.values())

    assert sorted(r.doc_id for r in private) == sorted(r.doc_id for r in alone)
    before = {r.doc_id: r.text for r in alone}
    hidden = re.compile(r"[\w.+-]+@[\w.-]+|\b\d{16}\b|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b")
    for r in private:
        assert not set(hidden.findall(before[r.doc_id])) & set(hidden.findall(r.text))
        if not re.search(r"[0-9@]", before[r.doc_id]):
            assert r.text == before[r.doc_id]
        assert r.n_chars == len(r.text)

    total = sum(len(brute.words(r.text)) for r in private)
    assert abs(sum(len(brute.words(r.text)) for r in mixed) - total) <= 20
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3
    texts = {r.doc_id: r.text for r in private}
    assert all(texts[r.doc_id].startswith(r.text) for r in mixed)

    assert sum(r.length for r in packed) == sum(len(x) + 1 for x in plain_ids([r.text for r in mixed]))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_odd_rows(spark, messy, no_documents, tmp_path, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (messy, no_documents):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), name)
            if name != "packing":
                assert docs.columns == columns
        docs.count()
