from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendlake.operators.ranking import number_rows, share_of_group


@pytest.mark.parametrize("seed", [1, 2])
def test_number_rows_equals_brute_force_on_a_hot_group(spark, seed):
    """Most rows in one group, with heavy ties, over many partitions."""
    rng = random.Random(seed)
    data = [
        (rng.choice(["us"] * 8 + ["gb", None]), rng.choice([0, 0, 0, 5, i]), f"c{i:05d}")
        for i in range(5_000)
    ]
    groups = defaultdict(list)
    for region, views, channel in data:
        groups[region].append((-views, channel))
    expected = [
        (region, -views, channel, place)
        for region, members in groups.items()
        for place, (views, channel) in enumerate(sorted(members), start=1)
    ]
    df = spark.createDataFrame(data, "region string, views bigint, channel string").repartition(9)
    got = number_rows(df, ["region"], [F.col("views").desc(), F.col("channel").asc()], "place")
    assert rows(got) == sorted(expected, key=repr)


def test_number_rows_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert rows(number_rows(df, ["g"], [F.col("v")], "n")) == []


def test_share_of_group(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 0), ("c", 7)], "g string, v bigint"
    )
    got = rows(share_of_group(df, "v", ["g"], "pct"))
    assert got == [("a", 1, 33.33), ("a", 2, 66.67), ("b", 0, None), ("c", 7, 100.0)]


def test_share_of_a_hot_group_without_a_window(spark):
    """A third of all rows in one group, another third in the NULL group, over many partitions."""
    rng = random.Random(3)
    data = [(rng.choice(["us", None, f"g{i % 50}"]), rng.randrange(1000)) for i in range(6_000)]
    totals = defaultdict(int)
    for group, value in data:
        totals[group] += value
    df = spark.createDataFrame(data, "g string, v bigint").repartition(9)
    got = share_of_group(df, "v", ["g"], "pct")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert {(g, v): p for g, v, p in got.collect()} == {
        (g, v): pytest.approx(v / totals[g] * 100, abs=0.0051) for g, v in data
    }
    assert got.count() == len(data)
