"""Cleansing, derived measures and audit columns of statistics rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions.values import clean_region, percent, settled, trending_day
from trendlake.schemas import COUNT_COLUMNS, WARNING_COLUMNS


def drop_corrupt(df: DataFrame) -> DataFrame:
    """Rows without a video id come from broken input."""
    return df.dropna(subset=["video_id"])


def fill_counts(df: DataFrame) -> DataFrame:
    return df.fillna(0, subset=list(COUNT_COLUMNS))


def derive_ratios(df: DataFrame) -> DataFrame:
    """Likes, and all reactions, in percent of views.

    The percentages are columns of their own first, which keeps the generated code small
    enough to be compiled.
    """
    views, likes = F.col("views"), F.col("likes")
    reactions = likes + F.col("dislikes") + F.col("comment_count")
    unrounded = df.withColumns(
        {"_likes_pct": percent(likes, views), "_reactions_pct": percent(reactions, views)}
    )
    return unrounded.withColumns(
        {
            "like_ratio": settled(F.col("_likes_pct"), views),
            "engagement_rate": settled(F.col("_reactions_pct"), views),
        }
    ).drop("_likes_pct", "_reactions_pct")


def cleanse(df: DataFrame) -> DataFrame:
    """All cleansing rules in one projection over the scan."""
    tidy = drop_corrupt(df).withColumns(
        {
            "region": clean_region(F.col("region")),
            "trending_date_parsed": trending_day(F.col("trending_date")),
        }
    )
    return derive_ratios(fill_counts(tidy))


def clock(as_of: datetime | None):
    """The given time as a column, or the start time of the query."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def with_audit(df: DataFrame, job: str, as_of: datetime | None = None) -> DataFrame:
    return df.withColumns({"_processed_at": clock(as_of), "_job_name": F.lit(job)})


def row_warnings(df: DataFrame, prefix: str = "") -> DataFrame:
    """One row: total rows, NULLs per watched column, negative view counts.

    One pass for all of them. Run it before cleansing as well as after: afterwards video_id
    and views can't be NULL any more.
    """
    nulls = [
        F.count_if(F.col(name).isNull()).alias(f"{prefix}null_{name}")
        for name in WARNING_COLUMNS
    ]
    return df.agg(
        F.count(F.lit(1)).alias(f"{prefix}rows"),
        *nulls,
        F.count_if(F.col("views") < 0).alias(f"{prefix}negative_views"),
    )
