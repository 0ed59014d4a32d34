"""Raw frames to the cleansed tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake import schemas
from trendlake.functions.columns import flatten, require_columns
from trendlake.functions.values import clean_region
from trendlake.operators.cleanse import cleanse, clock, with_audit
from trendlake.operators.counts import LoadCounts
from trendlake.operators.dedup import keep_last, latest_per_key
from trendlake.operators.normalize import unify
from trendlake.schemas import INGESTED_AT
from trendlake.sources.categories import LANDED_AT, POSITION
from trendlake.sources.documents import SOURCE_FILE

STATISTICS_JOB = "build_silver_statistics"


def build_silver_statistics(
    *raw: DataFrame,
    job: str = STATISTICS_JOB,
    as_of: datetime | None = None,
    newest_first: Sequence[str] = (INGESTED_AT,),
    counts: LoadCounts | None = None,
) -> DataFrame:
    """Raw frames of either format to clean_statistics: one row per video, region and day,
    the one that was ingested last. One shuffle. ``counts`` are known once the result is written."""
    rows = unify(*raw, run_time=clock(as_of), carry=newest_first)
    if counts is None:
        return with_audit(latest_statistics(cleanse(rows), newest_first), job, as_of)
    latest = latest_statistics(counts.cleansed(cleanse(counts.read(rows))), newest_first)
    return with_audit(counts.written(latest), job, as_of)


def latest_statistics(
    rows: DataFrame, newest_first: Sequence[str] = (INGESTED_AT,)
) -> DataFrame:
    order = [name for name in newest_first if name in rows.columns]
    return latest_per_key(rows, schemas.VIDEO_DAY_KEY, order)


def build_silver_reference(items: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Category items of all files at once to clean_reference_data.

    The newest document of a region stands for the region, and within it the last item of an
    id wins. Regions are spelled as in the statistics.
    """
    require_columns(items.schema, ("id", "snippet.title"), on_missing="warn")
    clean = items.withColumn("region", clean_region(F.col("region")))
    last = keep_last(newest_document(clean), ("region", SOURCE_FILE, "id"), POSITION)
    return flatten(last).withColumn("_ingestion_timestamp", clock(as_of))


def newest_document(items: DataFrame) -> DataFrame:
    """Only the items of each region's newest document; of equally old files the last by name."""
    document = F.struct(LANDED_AT, SOURCE_FILE)
    newest = items.groupBy("region").agg(F.max(document).alias("_document")).select(
        F.col("region").alias("_region"), F.col("_document").alias("_newest")
    )
    same = F.col("region").eqNullSafe(F.col("_region")) & document.eqNullSafe(F.col("_newest"))
    return items.join(newest, same, "left_semi")


def require_items(items: DataFrame) -> DataFrame:
    """Fail if no file has any category item."""
    if items.isEmpty():
        raise ValueError("no category items found")
    return items
