from __future__ import annotations

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from trendlake.operators.cleanse import cleanse, row_warnings
from trendlake.operators.dedup import keep_last, latest_per_key, removed_by_dedup
from trendlake.operators.normalize import API, BULK, detect_format, unify
from trendlake.plans.silver import build_silver_statistics
from trendlake.schemas import CLEAN_STATISTICS, STATISTICS

SOURCES = {
    "id": "v1",
    "snippet.title": "t",
    "snippet.channelTitle": "ch",
    "snippet.categoryId": "10",
    "snippet.publishedAt": "p",
    "snippet.tags": "a|b",
    "statistics.viewCount": "100",
    "statistics.likeCount": "10",
    "statistics.dislikeCount": "3",
    "statistics.commentCount": "2",
    "snippet.thumbnails.default.url": "u",
    "snippet.description": "d",
    "region": " US ",
}


def flat(spark, separator):
    names = [name.replace(".", separator) for name in SOURCES]
    schema = ", ".join(f"`{name}` string" for name in names)
    return spark.createDataFrame([tuple(SOURCES.values())], schema)


def bulk(spark, **changes):
    values = dict.fromkeys(STATISTICS) | {
        "video_id": "v1", "trending_date": "24.01.03", "title": "t", "channel_title": "ch",
        "category_id": "10", "publish_time": "p", "tags": "a|b", "views": "100", "likes": "10",
        "dislikes": "3", "comment_count": "2", "thumbnail_link": "u",
        "comments_disabled": "False", "ratings_disabled": "false",
        "video_error_or_removed": "FALSE", "description": "d", "region": " US ",
    } | changes
    return spark.createDataFrame(
        [tuple(values.values())], ", ".join(f"{name} string" for name in values)
    )


def test_all_spellings_give_one_frame(spark, noon):
    frames = [flat(spark, s) for s in (".", "__", "_")] + [bulk(spark)]
    assert [detect_format(f.schema) for f in frames] == [API, API, API, BULK]
    got = unify(*frames, run_time=F.lit(noon))
    assert got.columns == list(STATISTICS)
    assert dict(got.dtypes) == STATISTICS
    assert got.distinct().count() == 1 and got.count() == 4


def test_api_rows_may_lack_fields(spark, noon):
    df = flat(spark, ".").drop("statistics.dislikeCount", "snippet.tags", "snippet.thumbnails.default.url")
    got = unify(df, run_time=F.lit(noon))
    assert rows(got, "dislikes", "tags", "thumbnail_link", "trending_date") == [(0, None, None, "24.01.03")]


def test_cleanse_edges(spark):
    df = unify(
        bulk(spark),
        bulk(spark, video_id=None),
        bulk(spark, video_id="", views=None, likes="x", category_id="x", region=None),
        bulk(spark, video_id="v0", views="0", trending_date="garbage"),
        bulk(spark, video_id="v9", views="3", likes="1", dislikes="0", comment_count="0"),
    )
    got = cleanse(df)
    assert rows(
        got, "video_id", "region", "views", "likes", "category_id", "like_ratio",
        "engagement_rate", "trending_date_parsed",
    ) == [
        ("", None, 0, 0, None, 0.0, 0.0, date(2024, 3, 1)),
        ("v0", "us", 0, 10, 10, 0.0, 0.0, None),
        ("v1", "us", 100, 10, 10, 10.0, 15.0, date(2024, 3, 1)),
        ("v9", "us", 3, 1, 10, 33.3333, 33.3333, date(2024, 3, 1)),
    ]
    assert rows(row_warnings(df, "raw_"))[0] == (5, 1, 0, 0, 1, 0)
    assert row_warnings(got).columns[:2] == ["rows", "null_video_id"]


def test_silver_columns(spark, noon):
    got = build_silver_statistics(bulk(spark).withColumn("_ingested_at", F.lit(noon)), as_of=noon)
    assert dict(got.dtypes) == {f.name: f.dataType.simpleString() for f in CLEAN_STATISTICS}
    assert got.drop("_ingested_at").distinct().count() == 1


def test_latest_per_key_is_independent_of_order(spark):
    data = [
        (k, v, t, text)
        for k in ("a", None)
        for v, t in [(1, 3), (2, 7), (3, 7)]
        for text in ("x", "y")
    ]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, v int, t int, text string").repartition(5)
        # Full ties on time go by the other columns, ascending.
        assert rows(latest_per_key(df, ["k"], ["t"])) == [("a", 2, 7, "x"), (None, 2, 7, "x")]


def test_hot_key_is_reduced_before_the_shuffle(spark, plan):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = latest_per_key(df.repartition(8), ["k"], ["id"])
    assert got.filter("k = 'hot'").collect()[0]["id"] == 9_999 - (1 if 9_999 % 3 == 2 else 0)
    assert plan(got).count("WindowGroupLimit [k") >= 2


def test_keep_last_and_removed_rows(spark):
    df = spark.createDataFrame([("f", "1", 0, "a"), ("f", "1", 2, "b"), ("g", "1", 0, "c")], "f string, id string, at int, x string")
    assert rows(keep_last(df, ["f", "id"], "at")) == [("f", "1", "b"), ("g", "1", "c")]
    assert rows(removed_by_dedup(df, ["f", "id"])) == [(3, 2, 1)]
    assert rows(removed_by_dedup(df.limit(0), ["f", "id"])) == [(0, 0, 0)]


def test_newest_ingestion_wins(spark, noon):
    old = bulk(spark, views="1").withColumn("_ingested_at", F.lit(datetime(2024, 3, 1)))
    new = bulk(spark, views="2").withColumn("_ingested_at", F.lit(datetime(2024, 3, 2)))
    other = bulk(spark, views="3", region="gb").withColumn("_ingested_at", F.lit(datetime(2024, 1, 1)))
    got = build_silver_statistics(new, old, other, as_of=noon)
    assert rows(got, "region", "views") == [("gb", 3), ("us", 2)]
