"""Raw API documents: the ingestion envelope and what was landed per region and file."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.functions.values import clean_region
from trendlake.operators.cleanse import clock
from trendlake.schemas import INGESTION_ID_FORMAT, REGIONS
from trendlake.sources.documents import SOURCE_FILE, unreadable

COUNTS = ("documents", "videos", "unreadable")
UNREADABLE, NO_ITEMS, NOT_LANDED = "unreadable document", "no category items", "no document"


def region_list(text: Column) -> Column:
    """A comma-separated list of regions as an array of clean codes."""
    return F.transform(F.split(text, ","), clean_region)


def parse_regions(text: str | None) -> list[str]:
    """The same for a setting; the default list if there is none."""
    return [part.strip().lower() for part in text.split(",")] if text else list(REGIONS)


def envelope(
    documents: DataFrame,
    source: str,
    as_of: datetime | Column | None = None,
    count_items: bool = True,
) -> DataFrame:
    """Add ``_pipeline_metadata`` to documents that have a region column.

    Video documents carry the number of their items as well; for category documents
    switch it off.
    """
    now = as_of if isinstance(as_of, Column) else clock(as_of)
    fields = [
        F.date_format(now, INGESTION_ID_FORMAT).alias("ingestion_id"),
        F.col("region").alias("region"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("ingestion_timestamp"),
    ]
    if count_items:
        n = F.when(F.col("items").isNull(), 0).otherwise(F.size("items"))
        fields.append(n.cast("bigint").alias("video_count"))
    fields.append(F.lit(source).alias("source"))
    return documents.withColumn("_pipeline_metadata", F.struct(*fields))


def landed_counts(documents: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    """Documents, videos of those that are readable, and unreadable documents, per region or file."""
    return documents.groupBy(*by).agg(*(column.alias(name) for name, column in count_columns(unreadable(documents)).items()))


def count_columns(bad: Column, of: Column | None = None) -> dict[str, Column]:
    """The aggregates of :func:`landed_counts`, of all documents or of those that a condition holds for."""
    of = F.lit(True) if of is None else of
    return {
        "documents": F.count_if(of),
        "videos": F.coalesce(F.sum(F.when(of & ~bad, F.size("items"))), F.lit(0)),
        "unreadable": F.count_if(of & bad),
    }


def ingest_summary(documents: DataFrame, expected: DataFrame) -> DataFrame:
    """Per expected region: documents and videos landed, unreadable documents, status.

    ``expected`` has one ``region`` column. A region is successful if it has a readable
    document and none that isn't.
    """
    return summary_of_counts(landed_counts(documents), expected)


def summary_of_counts(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """The :func:`ingest_summary` from the :func:`landed_counts` of regions."""
    counts = list(COUNTS)
    failed = (F.col("documents") == 0) | (F.col("unreadable") > 0)
    return (
        expected.join(landed, "region", "left")
        .fillna(0, subset=counts)
        .select(
            "region", *counts, F.when(failed, "failed").otherwise("success").alias("status")
        )
    )


def file_summary(documents: DataFrame) -> DataFrame:
    """Per category file: region, distinct categories, and what is wrong with it, if so.

    Reads documents, not their items, so that files without any item show up too.
    """
    bad = unreadable(documents)
    ids = F.array_distinct(F.transform("items", lambda item: item["id"]))
    per_document = F.when(bad, 0).when(F.col("items").isNull(), 1).otherwise(F.size(ids))
    return (
        documents.groupBy(F.col(SOURCE_FILE).alias("file"), "region")
        .agg(F.sum(per_document).cast("bigint").alias("rows"), F.count_if(bad).alias("_bad"))
        .select(
            "file",
            "region",
            "rows",
            F.when(F.col("_bad") > 0, UNREADABLE)
            .when(F.col("rows") == 0, NO_ITEMS)
            .alias("error"),
        )
    )


def region_outcomes(videos: DataFrame, files: DataFrame) -> DataFrame:
    """Per region of an :func:`ingest_summary`: success, or which step failed and why.

    Category files are those of a :func:`file_summary`. A region whose videos failed is not
    asked for its categories.
    """
    categories = (
        files.groupBy(clean_region(F.col("region")).alias("region"))
        .agg(F.count(F.lit(1)).alias("_files"), F.min("error").alias("_error"))
    )
    no_videos = F.col("status") == "failed"
    video_error = F.when(F.col("unreadable") > 0, UNREADABLE).otherwise(NOT_LANDED)
    no_categories = F.col("_files").isNull() | F.col("_error").isNotNull()
    return videos.join(categories, "region", "left").select(
        "region",
        F.when(no_videos | no_categories, "failed").otherwise("success").alias("status"),
        F.when(no_videos, "trending").when(no_categories, "categories").alias("type"),
        F.when(no_videos, video_error)
        .when(F.col("_files").isNull(), NOT_LANDED)
        .otherwise(F.col("_error"))
        .alias("error"),
    )


def expected_regions(spark, regions: Iterable[str]) -> DataFrame:
    """A literal list of regions as a frame."""
    return spark.createDataFrame([(region,) for region in regions], "region string")
