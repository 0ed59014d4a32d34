"""The shared test tables in the shape of raw statistics and category reference data.

They have no video statistics, so columns of like type and spread stand in for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.functions.values import clean_region
from trendlake.operators.categories import unique_names
from trendlake.schemas import INGESTED_AT, STATISTICS
from trendlake.sources.documents import FILE_TIME, SOURCE_FILE

SOURCE_ROW = "_source_row"
NEWEST_FIRST = (INGESTED_AT, SOURCE_ROW)
CATEGORY_IDS = 30
FIRST_FILE_SECOND = 1_704_067_200  # 2024-01-01 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (table(spark, sf_dir, name) for name in ("nation", "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nation"), "r_name"
    )


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(nation_regions(spark, sf_dir), F.col("c_nationkey") == F.col("nation"))
        .select("c_custkey", "c_name", "c_mktsegment", "r_name")
    )


def event_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as bulk rows: all text, short dates, padded regions, some views missing."""
    people = customer_regions(spark, sf_dir)
    events = table(spark, sf_dir, "events").join(
        people, F.col("user_id") == F.col("c_custkey")
    )
    k = F.get_json_object("props", "$.k").cast("bigint")
    views = F.when(F.col("user_id") % 10 != 0, F.round(F.col("value") * 100).cast("bigint"))
    built = {
        "video_id": F.concat(F.lit("v"), F.col("user_id")),
        "trending_date": F.date_format("ts", "yy.dd.MM"),
        "title": F.col("event_type"),
        "channel_title": F.col("c_mktsegment"),
        "category_id": k % CATEGORY_IDS,
        "publish_time": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "tags": F.concat_ws("|", "event_type", "c_mktsegment"),
        "views": views,
        "likes": k,
        "dislikes": F.col("user_id") % 7,
        "comment_count": F.col("event_id") % 11,
        "thumbnail_link": F.concat(F.lit("img/"), F.col("event_id")),
        "comments_disabled": F.col("event_id") % 2 == 0,
        "ratings_disabled": F.col("event_id") % 3 == 0,
        "video_error_or_removed": F.col("event_id") % 5 == 0,
        "description": F.col("c_name"),
        "region": F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")),
    }
    return events.select(
        *(built[name].cast("string").alias(name) for name in STATISTICS),
        F.col("ts").cast("timestamp").alias(INGESTED_AT),
        F.col("event_id").alias(SOURCE_ROW),
    )


def event_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as nested API videos. Their day is the day of ingestion."""
    rows = event_statistics(spark, sf_dir)
    snippet = F.struct(
        "title",
        F.col("channel_title").alias("channelTitle"),
        F.col("category_id").alias("categoryId"),
        F.col("publish_time").alias("publishedAt"),
        F.split("tags", r"\|").alias("tags"),
        "description",
        F.struct(F.struct(F.col("thumbnail_link").alias("url")).alias("default")).alias(
            "thumbnails"
        ),
    )
    statistics = F.struct(
        F.col("views").alias("viewCount"),
        F.col("likes").alias("likeCount"),
        F.col("dislikes").alias("dislikeCount"),
        F.col("comment_count").alias("commentCount"),
    )
    return rows.select(
        F.col("video_id").alias("id"),
        snippet.alias("snippet"),
        statistics.alias("statistics"),
        "region",
        INGESTED_AT,
        SOURCE_ROW,
    )


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as API documents of one item each, in which views may be missing."""
    items = F.array(F.struct("id", "snippet", "statistics"))
    return event_videos(spark, sf_dir).select(
        clean_region(F.col("region")).alias("region"), items.alias("items"), INGESTED_AT
    )


def supplier_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` as category items of several files per region, each id listed twice."""
    rows = table(spark, sf_dir, "supplier").join(
        nation_regions(spark, sf_dir), F.col("s_nationkey") == F.col("nation")
    )

    def item(title):
        return F.struct(
            F.lit("category").alias("kind"),
            F.concat(F.lit("e"), F.col("s_suppkey")).alias("etag"),
            F.col("s_suppkey").cast("string").alias("id"),
            F.struct(
                F.concat(F.lit("c"), F.col("s_nationkey")).alias("channelId"),
                title.alias("title"),
                (F.col("s_acctbal") > 0).alias("assignable"),
            ).alias("snippet"),
        )

    listed = F.array(item(F.lit("superseded")), item(F.col("s_name")))
    return rows.select(
        F.concat(F.lit(" "), F.col("r_name")).alias("region"),
        F.concat_ws("/", "r_name", "s_nationkey").alias(SOURCE_FILE),
        F.timestamp_seconds(F.lit(FIRST_FILE_SECOND) + F.col("s_nationkey") * 86_400).alias(FILE_TIME),
        listed.alias("items"),
    )


def nation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as one category document per nation."""
    snippet = F.struct(
        F.lit("c").alias("channelId"),
        F.col("n_name").alias("title"),
        F.lit(True).alias("assignable"),
    )
    item = F.struct(
        F.lit("category").alias("kind"),
        F.lit("e").alias("etag"),
        F.col("n_nationkey").cast("string").alias("id"),
        snippet.alias("snippet"),
    )
    return table(spark, sf_dir, "nation").select(
        F.lower("n_name").alias("region"),
        F.lit("list").alias("kind"),
        F.lit("e").alias("etag"),
        F.array(item).alias("items"),
    )


def lineitem_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its dimensions as a larger bulk frame, with typed columns and ISO
    dates."""
    people = customer_regions(spark, sf_dir).select("c_custkey", "r_name")
    orders = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    built = {
        "video_id": F.concat(F.lit("p"), F.col("l_partkey")),
        "trending_date": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "title": F.col("p_name"),
        "channel_title": F.col("p_brand"),
        "category_id": F.col("s_nationkey").cast("bigint"),
        "publish_time": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "tags": F.col("p_type"),
        "views": F.round(F.col("l_extendedprice") * 100).cast("bigint"),
        "likes": F.col("l_quantity").cast("bigint"),
        "dislikes": F.col("l_linenumber").cast("bigint"),
        "comment_count": F.round(F.col("l_discount") * 100).cast("bigint"),
        "thumbnail_link": F.lit(None).cast("string"),
        "comments_disabled": F.col("l_returnflag") == "N",
        "ratings_disabled": F.col("l_linestatus") == "F",
        "video_error_or_removed": F.col("l_returnflag") == "R",
        "description": F.concat_ws(" ", "p_name", "p_type"),
        "region": F.col("r_name"),
    }
    return rows.select(
        *(built[name].alias(name) for name in STATISTICS),
        F.col("o_orderdate").cast("timestamp").alias(INGESTED_AT),
        F.col("l_orderkey").alias(SOURCE_ROW),
    )


def nation_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as category lookup; ids from 25 on have no name there."""
    return unique_names(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("category_id"),
            F.col("n_name").alias("category_name"),
        )
    )
