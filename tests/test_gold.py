from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendlake.operators.categories import category_lookup, enrich_category
from trendlake.plans import gold, reports

SCHEMA = (
    "video_id string, channel_title string, category_id bigint, region string,"
    " trending_date_parsed date, views bigint, likes bigint, dislikes bigint,"
    " comment_count bigint, like_ratio double, engagement_rate double"
)
NAMES = {1: "Film", 23: "Comedy", 34: "Comedy"}


def some_stats(n, seed=7):
    """A third and more of all rows in one region, channel and day, some keys NULL."""
    rng = random.Random(seed)
    for _ in range(n):
        hot = rng.random() < 0.4
        yield (
            f"v{rng.randrange(n // 3)}",
            "hot" if hot else rng.choice(["a", "b", "c", None]),
            rng.choice([1, 23, 34, 99, None]),
            "us" if hot else rng.choice(["gb", "us", None]),
            date(2024, 1, 1) if hot else rng.choice([date(2024, 1, 2), None]),
            rng.randrange(1000),
            rng.randrange(100),
            rng.randrange(10),
            rng.randrange(10),
            round(rng.random() * 100, 4),
            round(rng.random() * 100, 4),
        )


@pytest.fixture(scope="module")
def data():
    return list(some_stats(600))


@pytest.fixture(scope="module")
def stats(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(7)


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame(list(NAMES.items()), "category_id bigint, category_name string")


def mean(values):
    return sum(round(v * 10_000) for v in values) / len(values) / 10_000


def distinct(values):
    return len({v for v in values if v is not None})


def grouped(data, *places):
    groups = defaultdict(list)
    for row in data:
        groups[tuple(row[p] for p in places)].append(row)
    return groups


def test_trending_analytics(stats, data):
    expected = [
        (*key, len(g), sum(r[5] for r in g), sum(r[6] for r in g), sum(r[7] for r in g),
         sum(r[8] for r in g), sum(r[5] for r in g) / len(g), mean([r[9] for r in g]),
         mean([r[10] for r in g]), max(r[5] for r in g), distinct(r[1] for r in g),
         distinct(r[2] for r in g))
        for key, g in grouped(data, 3, 4).items()
    ]
    got = rows(gold.trending_analytics(stats).drop("_aggregated_at"))
    assert got == sorted(expected, key=repr)


def test_category_analytics(stats, data, lookup):
    totals = {key: sum(r[5] for r in g) for key, g in grouped(data, 3, 4).items()}
    expected = [
        (NAMES.get(key[0], "Unknown"), *key, len(g), sum(r[5] for r in g), sum(r[6] for r in g),
         sum(r[8] for r in g), mean([r[10] for r in g]), distinct(r[1] for r in g),
         pytest.approx(sum(r[5] for r in g) / totals[key[1:]] * 100, abs=0.00501))
        for key, g in grouped(data, 2, 3, 4).items()
    ]
    got = rows(gold.category_analytics(stats, lookup).drop("_aggregated_at"))
    assert len(got) == len(expected)
    assert dict((r[:4], r) for r in got) == dict((r[:4], r) for r in expected)


def test_channel_analytics(stats, data, lookup):
    expected = []
    by_region = defaultdict(list)
    for (channel, region), g in grouped(data, 1, 3).items():
        days = [r[4] for r in g if r[4] is not None]
        names = sorted({NAMES.get(r[2], "Unknown") for r in g})
        by_region[region].append(
            (-sum(r[5] for r in g), channel or "", (
                channel, region, distinct(r[0] for r in g), sum(r[5] for r in g),
                sum(r[6] for r in g), sum(r[8] for r in g), sum(r[5] for r in g) / len(g),
                mean([r[10] for r in g]), max(r[5] for r in g), len(days),
                min(days, default=None), max(days, default=None), names,
            ))
        )
    for members in by_region.values():
        for place, (_, _, row) in enumerate(sorted(members, key=lambda m: m[:2]), start=1):
            expected.append((*row, place))
    got = rows(gold.channel_analytics(stats, lookup).drop("_aggregated_at"))
    assert got == sorted(expected, key=repr)


def test_build_gold_equals_single_tables(stats, lookup):
    as_of = datetime(2024, 1, 1)
    built = gold.build_gold(stats, lookup, as_of)
    assert rows(built.trending_analytics) == rows(gold.trending_analytics(stats, as_of))
    assert rows(built.category_analytics) == rows(gold.category_analytics(stats, lookup, as_of))
    assert rows(built.channel_analytics) == rows(gold.channel_analytics(stats, lookup, as_of))


def test_named_statistics_keep_their_names(stats, lookup):
    named = enrich_category(stats, lookup)
    got = gold.category_analytics(named).drop("_aggregated_at")
    assert rows(got) == rows(gold.category_analytics(stats, lookup).drop("_aggregated_at"))
    assert rows(gold.trending_analytics(named).drop("_aggregated_at")) == rows(
        gold.trending_analytics(stats).drop("_aggregated_at")
    )


def test_share_of_a_day_without_views(spark):
    row = ("v", "c", 1, "us", date(2024, 1, 1), 0, 0, 0, 0, 0.0, 0.0)
    got = gold.category_analytics(spark.createDataFrame([row], SCHEMA))
    assert rows(got, "view_share_pct", "category_name") == [(None, "Unknown")]


def test_lookup_is_region_blind_and_unique(spark):
    reference = spark.createDataFrame(
        [("29", "Nonprofits", "us"), ("1", "Film", "us"), ("1", "Film", "gb"), ("x", "bad", "gb")],
        "id string, snippet_title string, region string",
    )
    lookup = category_lookup(reference)
    assert rows(lookup) == [(1, "Film"), (29, "Nonprofits")]
    dotted = reference.withColumnRenamed("snippet_title", "snippet.title")
    assert rows(category_lookup(dotted)) == rows(lookup)
    with pytest.warns(UserWarning, match="no category"):
        assert category_lookup(reference.drop("snippet_title")) is None
    assert category_lookup(None) is None


def test_lookup_is_broadcast_only_while_small(spark, stats, lookup, plan):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    small = rows(enrich_category(stats, lookup))
    try:
        spark.conf.set(key, "-1")
        joined = enrich_category(stats, lookup)
        assert "SortMergeJoin" in plan(joined)
        assert rows(joined) == small
    finally:
        spark.conf.set(key, before)


def test_reports(stats, lookup, data):
    category = gold.category_analytics(stats, lookup)
    trending = gold.trending_analytics(stats)
    top = reports.top_category_days(category, 3).collect()
    views = [r["total_views"] for r in top]
    assert views == sorted(views, reverse=True) and len(top) == 3
    names = [r["category_name"] for r in reports.top_categories(category).collect()]
    assert len(names) == len(set(names))
    per_region = reports.videos_per_region(stats).collect()
    assert sum(r["video_count"] for r in per_region) == len(data)
    assert sum(r[1] for r in rows(reports.regions_by_videos(trending))) == len(data)
    assert sum(r[1] for r in rows(reports.regions_by_days(trending))) == trending.count()
    counted = rows(reports.row_counts({"a": category, "b": trending}))
    assert counted == [("a", category.count()), ("b", trending.count())]
    reports.register_views({"trending_analytics": trending})
    sql = trending.sparkSession.sql(
        "SELECT region, COUNT(*) AS trending_videos FROM trending_analytics GROUP BY region"
    )
    assert rows(sql) == rows(reports.regions_by_days(trending))


def test_top_videos(spark):
    raw = spark.range(30).select(
        F.concat(F.lit("v"), "id").alias("video_id"), F.lit("24.01.01").alias("trending_date"),
        F.lit("t").alias("title"), (F.col("id") % 15).alias("views"), F.col("id").alias("likes"),
        F.when(F.col("id") < 28, "in").otherwise("us").alias("region"),
    )
    got = reports.top_videos(raw, "in").collect()
    assert [(r["video_id"], r["views"]) for r in got[:3]] == [("v14", 14), ("v13", 13), ("v12", 12)]
    assert len(got) == 10
