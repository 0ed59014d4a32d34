from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.compare import spark_result, sql_result
from tests.llm.conftest import SF_DIR
from trendlake.llm import queries, spelling, sql


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, ratio):
    form, rows = {}, {}
    for w, n in counts.items():
        near = sorted((-counts[v], v) for v in counts if one_edit(w, v))
        best = near[0] if near and -near[0][0] >= ratio * n else None
        form[w] = best and best[1]
        rows[w] = (n, len(near), best and -best[0])
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, *rows[w]))
    return sorted(out, key=repr)


def words(seed):
    rng = random.Random(seed)
    found = {"".join(rng.choices("abé$", k=rng.randint(0, 5))): rng.randint(1, 300) for _ in range(250)}
    found |= {"x" * 30: 7, "x" * 31: 2, "x" * 29: 2, "ß\U0001f600": 3, "ß\U0001f601": 40, "long" * 300: 1, "long" * 300 + "g": 9}
    return found


@pytest.mark.parametrize("ratio", [5, 2])
def test_equals_plain(spark, ratio):
    counts = words(ratio)
    rows = [(w, n - 1, "x") for w, n in counts.items()] + [(w, 1, "y") for w in counts] + [(None, 9, "z")]
    table = spark.createDataFrame(rows, "word string, n long, stem string").repartition(5)
    got = spelling.variant_groups(table, ratio)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(counts, ratio)


def test_chain_of_forms(spark):
    counts = {"a" * i: 6 ** (9 - i) for i in range(1, 9)}
    got = spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long"), 5)
    assert {r.root for r in got.collect()} == {"a"}


def test_ratio_must_exceed_one(spark):
    with pytest.raises(ValueError, match="circles"):
        spelling.variant_groups(spark.createDataFrame([("a", 1)], "word string, n long"), 1)


def test_empty(spark, no_documents):
    assert spelling.variant_groups(spelling.count_words(queries.slipped_words(no_documents))).isEmpty()


def test_scan_takes_over_the_sort(spark, plan):
    text = plan(spelling.neighbours(spark.createDataFrame([("a", 1)], "word string, n long")))
    physical = text[text.index("Physical Plan") :]
    assert physical.count("rangepartitioning") == 1 and physical.count("Exchange hashpartitioning") == 1


def test_words_of_documents(spark, messy, messy_rows):
    counts = Counter()
    for row in messy_rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row[1] or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    expected = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = spelling.count_words(queries.slipped_words(messy))
    assert {r.word: r.n for r in got.collect()} == expected


def test_query_equals_sql(spark):
    got = spark_result(queries.op12_spelling_variants(spark, SF_DIR))
    assert got == sql_result(SF_DIR, sql.SQL["op12_spelling_variants"])
    assert any(row[got[0].index("form")] for row in got[1])
