from __future__ import annotations

import math
import random
from datetime import date

from pyspark.sql import functions as F

from tests.conftest import rows
from trendlake.functions.values import (
    clean_region,
    convert,
    fixed_point,
    fixed_point_mean,
    percent,
    region_of_path,
    round_half_up,
    settled,
    to_long,
    trending_day,
)


def apply(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [row[0] for row in df.select(expression(F.col("x"))).collect()]


def test_to_long(spark):
    given = ["12", " 12 ", "12.7", "-3.9", "abc", "", None, "1e3", "9223372036854775808"]
    assert apply(spark, given, "string", to_long) == [12, 12, 12, -3, None, None, None, None, None]


def test_convert_by_source_type(spark):
    df = spark.createDataFrame(
        [(12345678.9, 3, True, ["a"], "yes")],
        "d double, i int, b boolean, a array<string>, t string",
    )
    got = df.select(
        *(
            convert(F.col(name), dict(df.dtypes)[name], kind)
            for name, kind in [
                ("d", "bigint"), ("i", "bigint"), ("b", "boolean"), ("a", "string"),
                ("t", "boolean"), ("i", "string"), ("t", "bigint"),
            ]
        )
    )
    assert tuple(got.first()) == (12345678, 3, True, "a", True, "3", None)


def test_trending_day(spark):
    day = date(2017, 11, 14)
    given = {
        "17.14.11": day,
        "2017-11-14": day,
        "99.01.01": date(2099, 1, 1),
        "17.31.02": None,
        "17.99.99": None,
        "garbage": None,
        "": None,
        "117.14.11": None,
    }
    assert apply(spark, list(given), "string", trending_day) == list(given.values())
    assert apply(spark, [None], "string", trending_day) == [None]


def test_clean_region(spark):
    given = [" US ", "us", "Us", None]
    assert apply(spark, given, "string", clean_region) == ["us", "us", "us", None]


def test_percent(spark):
    df = spark.createDataFrame(
        [(1, 3), (1, 0), (1, -5), (2, None), (None, 4)], "part bigint, whole bigint"
    )
    ratio = settled(percent(F.col("part"), F.col("whole")), F.col("whole"))
    got = [row[0] for row in df.select(ratio).collect()]
    assert got == [33.3333, 0.0, 0.0, 0.0, None]


def test_rounding_is_that_of_spark(spark):
    """Random values, ties and their neighbours, large, negative and special values."""
    rng = random.Random(3)
    values = [rng.random() * 10 ** rng.randrange(-6, 14) for _ in range(20_000)]
    ties = [(2 * n + 1) / 20_000 for n in range(5_000)]
    values += ties + [math.nextafter(t, 0) for t in ties] + [math.nextafter(t, 9e9) for t in ties]
    values += [likes / views * 100 for likes in range(60) for views in range(1, 130)]
    values += [-v for v in values[:3_000]] + [0.0, -0.0, 1e300, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    both = df.select("x", F.round("x", 4).alias("a"), round_half_up(F.col("x"), 4).alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_fixed_point_mean_ignores_order_and_size(spark):
    ratios = [0.1, 33.3333, 1e-4, 5e12, 2.5] * 40
    forward = spark.createDataFrame([(r,) for r in ratios], "r double").repartition(7)
    mean = fixed_point_mean(F.sum(fixed_point(F.col("r"))), F.count("r"))
    got = forward.agg(mean).first()[0]
    assert abs(got - sum(ratios) / len(ratios)) < 1e-3
    assert forward.limit(0).agg(mean).first()[0] is None


def test_region_of_path(spark):
    given = {
        "file:/a/region=US/date=2024-01-01/x.json": "US",
        "file:/a/region=us/region=gb/x.json": "us",
        "file:/a/region%3Dde/x%20y.json": "de",
        "file:/a/region=a+b/x.json": "a+b",
        "file:/a/region=/x.json": "unknown",
        "file:/a/subregion=us/x.json": "unknown",
        "file:/a/100%/x.json": "unknown",
    }
    got = apply(spark, list(given), "string", lambda c: region_of_path(c, "unknown"))
    assert got == list(given.values())


def test_rows_helper_sorts(spark):
    assert rows(spark.range(2)) == [(0,), (1,)]
