"""Report queries over the raw and report tables. Each also runs as SQL on the views of
:func:`register_views`."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under their table names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def _largest_first(df: DataFrame, value: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(value).desc_nulls_last(), *ties)


def videos_per_region(raw: DataFrame) -> DataFrame:
    counted = raw.groupBy("region").agg(F.count(F.lit(1)).alias("video_count"))
    return _largest_first(counted, "video_count", "region")


def region_videos(raw: DataFrame, region: str) -> DataFrame:
    """The columns of one region's rows that the top list shows."""
    return raw.filter(F.col("region") == region).select(
        "video_id", "trending_date", "title", "views", "likes"
    )


def top_videos(raw: DataFrame, region: str, n: int = 10) -> DataFrame:
    """A region's rows with the most views."""
    return _largest_first(
        region_videos(raw, region), "views", "video_id", "trending_date", "title", "likes"
    ).limit(n)


def top_category_days(category: DataFrame, n: int = 10) -> DataFrame:
    """Rows of category_analytics with the most views; a category can appear repeatedly."""
    order = ("category_name", "category_id", "region", "trending_date_parsed")
    return _largest_first(category, "total_views", *order).limit(n).select(
        "category_name", "total_views"
    )


def top_categories(category: DataFrame, n: int = 10) -> DataFrame:
    """Categories with the most views over all regions and days."""
    summed = category.groupBy("category_name").agg(F.sum("total_views").alias("total_views"))
    return _largest_first(summed, "total_views", "category_name").limit(n)


def regions_by_days(trending: DataFrame) -> DataFrame:
    """Region-days per region."""
    counted = trending.groupBy("region").agg(F.count(F.lit(1)).alias("trending_videos"))
    return _largest_first(counted, "trending_videos", "region")


def regions_by_videos(trending: DataFrame) -> DataFrame:
    """Trending videos per region, summed over days."""
    summed = trending.groupBy("region").agg(F.sum("total_videos").alias("trending_videos"))
    return _largest_first(summed, "trending_videos", "region")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    first, *rest = counts
    for one in rest:
        first = first.unionByName(one)
    return first
