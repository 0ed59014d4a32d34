from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trendlake.llm import quality_rules as Q

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_of_messy_texts(messy, messy_rows):
    got = messy.select("text", Q.statistics("text").alias("s")).select("text", "s.*").collect()
    assert len(got) == len(messy_rows)
    for row in got:
        assert {c: row[c] for c in STATS} == brute.statistics(row.text)


def test_judge_keeps_columns_and_equal_rows_alike(messy, labels):
    scored = messy.withColumn("s", Q.statistics("text"))
    limits = Q.fit(scored, labels, "lang", "s")
    got = Q.judge(scored, limits, "lang", "s", "kept").drop("s")
    assert got.columns == [*messy.columns, "kept"]
    rows = got.collect()
    assert len(rows) == messy.count()
    for row in rows:
        words, again = brute.statistics(row.text)["n_words"], brute.statistics(row.text)["n_repeat_words"]
        if words < 20 or 100 * again > 30 * words:
            assert not row.kept
        else:  # so few labels make no cutoff certain
            assert row.kept


def test_empty_table(no_documents, labels):
    scored = no_documents.withColumn("s", Q.statistics("text"))
    assert Q.judge(scored, Q.fit(scored, labels, "lang", "s"), "lang", "s", "kept").isEmpty()


@pytest.mark.parametrize("k,n", [(0, 10), (3, 400), (0, 100_000), (950, 100_000)])
def test_binomial_tail(spark, k, n):
    rate = 0.01
    got = spark.range(1).select(
        Q.log_binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), rate).alias("x")
    ).first().x
    terms = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate)
        for i in range(k + 1)
    ]
    top = max(terms)
    assert got == pytest.approx(top + math.log(sum(math.exp(t - top) for t in terms)), rel=1e-6)


def test_certified_levels_hold_the_bound(spark):
    # 1000 good documents, a few of them at high levels; a second stratum is too small to be certain.
    rows = [("x", 0 if i >= 30 else 1 + i % 12, 1) for i in range(1000)] + [("y", 0, 1)] * 20 + [("x", 12, 0)] * 50
    judged = spark.createDataFrame(rows, "lang string, level int, quality int")
    got = {r.lang: r.max_level for r in Q.certified_levels(judged, "lang", "level", "quality", 0.02, 0.05).collect()}
    assert got["y"] == Q.STEPS
    rejected = sum(1 for lang, level, quality in rows if lang == "x" and quality == 1 and level > got["x"])
    assert 0 < got["x"] < Q.STEPS and rejected < 20


def test_no_python_in_the_plan(messy, labels, plan):
    scored = messy.withColumn("s", Q.statistics("text"))
    text = plan(Q.judge(scored, Q.fit(scored, labels, "lang", "s"), "lang", "s", "kept"))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
