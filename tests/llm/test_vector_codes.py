from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import spark_result, sql_result
from tests.llm.conftest import SF_DIR
from trendlake.llm import queries, sql, topk, vector_codes


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def plain(rows, parts, entries, rounds):
    """Rows (id, v, label) of whole numbers by comparing each part with every entry."""
    rows = [r for r in rows if r[1] is not None]
    width = max(1, -(-max(len(r[1]) for r in rows) // parts))
    cut = [[(r[1] + [0] * (parts * width - len(r[1])))[p * width : (p + 1) * width] for p in range(parts)] for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, cut[i]))[:entries]
    books = [[cut[i][p] for i in order] for p in range(parts)]
    for round in range(rounds + 1):
        codes = [[min((apart(c[p], b), j) for j, b in enumerate(books[p])) for p in range(parts)] for c in cut]
        if round == rounds:
            break
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [c[p] for c, code in zip(cut, codes, strict=True) if code[p][1] == j]
                if mine:
                    books[p][j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return books, sorted(
        ((r[0], tuple(j for _, j in code), min(sum(d for d, _ in code), 2**63 - 1)) for r, code in zip(rows, codes, strict=True)), key=repr
    )


def make_rows(seed, scale, n=300, size=10):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, scale) for _ in range(size)] for _ in range(9)]
    rows = [(i, [round(x + rng.gauss(0, scale / 9)) for x in rng.choice(centres)], i % 3 or None) for i in range(n)]
    rows += [(n + i, rows[4][1], 7) for i in range(150)]
    rows += [(None, [1] * size, 1), (3, [2] * size, None), (999, [5, 6], 2), (1000, [], 2), (1001, None, 2), rows[8], rows[8]]
    return rows


@pytest.mark.parametrize("scale,entries,cells", [(40, 16, 1 << 14), (3, 64, 2), (2**40, 8, 5), (2**61, 8, 5), (1, 1000, 50)])
def test_equals_plain(spark, monkeypatch, scale, entries, cells):
    monkeypatch.setattr(vector_codes.Cells.__init__, "__defaults__", (cells,))
    monkeypatch.setattr(vector_codes, "NUMBERS", 5000)
    rows = make_rows(entries, scale)
    table = spark.createDataFrame([(i, label, v) for i, v, label in rows], "id long, label int, v array<bigint>").repartition(3)
    vectors, length = vector_codes.filled(table, 4)
    assert length == 12
    books = vector_codes.train(vectors, length, 4, entries, 3)
    expected_books, expected = plain(rows, 4, entries, 3)
    assert books.tolist() == expected_books
    got = vector_codes.encode(vectors, books)
    assert got.columns == ["id", "label", "code", "error"]
    assert sorted(((r.id, tuple(r.code), r.error) for r in got.collect()), key=repr) == expected


def test_cells_leave_out_dominated_entries_only():
    rng = np.random.default_rng(1)
    cells = vector_codes.Cells(rng.integers(-500, 500, (256, 4)))
    parts = rng.integers(-500, 500, (3000, 4))
    best, distance = cells.nearest(parts)
    square = ((parts[:, None, :] - cells.entries[None]) ** 2).sum(axis=2)
    assert (best == square.argmin(axis=1)).all() and (distance == square.min(axis=1)).all()
    listed = [len(x) for x in cells.new.values()]
    assert len(listed) < 2500 and np.mean(listed) < 100


def test_group_errors(spark):
    rows = [(1, "a", 3), (2, None, 4), (3, "a", 5), (4, None, 2**63 - 1)]
    got = vector_codes.group_errors(spark.createDataFrame(rows, "id long, g string, error long"), "g", "total")
    assert {r.id: r.total for r in got.collect()} == {1: 8, 3: 8, 2: 2**63 - 1, 4: 2**63 - 1}


def test_odd_floats(spark):
    rows = [(1, [1.0, -0.0005]), (2, [math.nan, 1.0]), (3, [math.inf, 0.0]), (4, None), (5, [None, 1.0]), (6, [1e300, -1e300])]
    whole = spark.createDataFrame(rows, "id long, e array<double>").select("id", topk.whole_numbers(F.col("e"), 1024).alias("v"))
    vectors, length = vector_codes.filled(whole, 2)
    books = vector_codes.train(vectors, length, 2, 4, 1)
    assert {r.id: r.code for r in vector_codes.encode(vectors, books).collect()} == {1: [0, 0], 6: [1, 1]}
    assert vectors.where("id = 1").first().v == [1024, -1]


def test_empty(spark):
    vectors, length = vector_codes.filled(spark.createDataFrame([], "id long, label int, v array<bigint>"), 4)
    books = vector_codes.train(vectors, length)
    coded = vector_codes.encode(vectors, books)
    assert vector_codes.group_errors(coded, "label", "label_error").isEmpty()


def test_query_equals_sql(spark):
    got = spark_result(queries.op13_vector_codes(spark, SF_DIR))
    assert got == sql_result(SF_DIR, sql.SQL["op13_vector_codes"])
