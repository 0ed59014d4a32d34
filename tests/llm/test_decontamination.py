from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.compare import spark_result, sql_result
from tests.llm.conftest import SF_DIR
from trendlake.llm import decontamination as dec
from trendlake.llm import queries, sql

NO_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in NO_WORD.split(lower) if w]


def plain(docs, items, window):
    """Rows of the contract by comparing every window at every place."""
    phrases = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            phrases.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for phrase, owners in phrases.items():
            for i in range(len(w) - len(phrase) + 1):
                if tuple(w[i : i + len(phrase)]) == phrase:
                    hit.update(range(i, i + len(phrase)))
                    ids |= owners - {None}
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def random_tables(seed):
    rng = random.Random(seed)

    def prose(n, alphabet):
        return "".join(rng.choice(alphabet) + rng.choice([" ", ", ", "-", "\n", " \u00a0 "]) for _ in range(n))

    items = [(i % 9, prose(rng.randint(0, 14), ["a", "B", "b", "c", "\u00e9"])) for i in range(12)]
    items += [(20, "a"), (21, "zz top"), (22, ""), (23, None), (None, "only Here"), (24, "!!! ?"), (25, "a a a a a a a")]
    docs = [(i, prose(rng.randint(0, 60), ["A", "b", "c", "\u00e9"])) for i in range(40)]
    docs += [(50, None), (51, ""), (None, "only here"), (52, " ".join(["a"] * 500)), (53, "ZZ-TOP"), (7, docs[7][1]), (7, docs[7][1])]
    docs += [(60 + i, docs[3][1] + " " + items[i][1]) for i in range(9)]
    return docs, items


@pytest.mark.parametrize("window,shard_bytes,chunk_words,starts", [(10, 1 << 20, 1 << 20, 1 << 20), (3, 200, 40, 1), (1, 1, 7, 5)])
def test_equals_plain(spark, monkeypatch, window, shard_bytes, chunk_words, starts):
    monkeypatch.setattr(dec, "STARTS", starts)
    docs, items = random_tables(window)
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, shard string, place int").repartition(3)
    phrases = dec.phrases_of(spark.createDataFrame(items, "item_id long, text string"), window)
    got = dec.contamination(dec.build_index(table, shard_bytes=shard_bytes), phrases, chunk_words)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, items, window)


def test_spans_and_item_names(spark):
    docs = spark.createDataFrame([("d", "x one two three one two x two"), ("e", "none")], "doc_id string, text string")
    phrases = dec.phrases_of(spark.createDataFrame([("p", "one two three"), ("q", "Two")], "item_id string, text string"), 2)
    found = {r.doc_id: r for r in dec.phrase_matches(dec.build_index(docs), phrases).collect()}
    assert [tuple(s) for s in found["d"].spans] == [(1, 6), (7, 8)]
    assert found["d"]["items"] == ["p", "q"]
    assert (found["e"].spans, found["e"]["items"], found["e"].n_words) == ([], [], 1)


@pytest.mark.parametrize("within", [2, 4, 9])
def test_proximity_equals_plain(spark, within):
    docs, items = random_tables(within)
    items = [(i, " ".join(words(t)[:3])) for i, t in items]
    expected = set()
    for doc, text in docs:
        w = words(text)
        for item, phrase in items:
            wanted = set(words(phrase))
            if not wanted or item is None:
                continue
            spans = [
                (b, e) for b in range(len(w)) for e in range(b + 1, min(b + within, len(w)) + 1) if wanted <= set(w[b:e])
            ]
            least = [(b, e) for b, e in spans if not any((x, y) != (b, e) and b <= x and y <= e for x, y in spans)]
            expected |= {(doc, item, b, e) for b, e in least}
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    phrases = dec.phrases_of(spark.createDataFrame(items, "item_id long, text string"), 10)
    got = dec.proximity_matches(dec.build_index(table, shard_bytes=300), phrases, within)
    assert set(map(tuple, got.collect())) == expected


def test_empty_tables(spark, no_documents, messy):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one"), (2, None)], none.schema)
    assert dec.contamination(dec.build_index(no_documents), dec.phrases_of(some)).isEmpty()
    got = dec.contamination(dec.build_index(messy), dec.phrases_of(none)).collect()
    assert len(got) == messy.count() and not any(r.n_hit or r.n_items or r.contaminated for r in got)
    assert dec.proximity_matches(dec.build_index(no_documents), dec.phrases_of(some), 5).isEmpty()


def test_query_equals_sql(spark):
    got = spark_result(queries.op11_decontamination(spark, SF_DIR))
    assert got == sql_result(SF_DIR, sql.SQL["op11_decontamination"])
    assert any(row[got[0].index("contaminated")] for row in got[1])
