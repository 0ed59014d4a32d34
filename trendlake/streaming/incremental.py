"""File streams that take in only what is new since their last run.

Each call processes all new files and returns; run it on a schedule, or give a trigger such as
``{"processingTime": "6 hours"}`` to keep it running. Progress is kept in the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from trendlake import schemas
from trendlake.operators.counts import LoadCounts
from trendlake.plans.maintenance import record_touched
from trendlake.plans.silver import (
    build_silver_reference,
    build_silver_statistics,
    latest_statistics,
    newest_document,
)
from trendlake.schemas import INGESTED_AT
from trendlake.sources.categories import category_items, category_schema, with_region
from trendlake.sources.documents import LANDING_FOLDERS, load_documents
from trendlake.sources.statistics import load_bulk, video_files, video_rows
from trendlake.sources.tables import only_regions
from trendlake.streaming.upsert import merge_partitions

ALL_NEW_FILES = {"availableNow": True}
STATISTICS_PARTITIONS = ("region", "trending_date_parsed")

Trigger = Mapping[str, object]
#: Files count as new however old they are; by default Spark leaves out what is a week older than the newest.
ANY_AGE = {"maxFileAge": "365000d"}


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger = ALL_NEW_FILES,
):
    """Start ``handle(batch, batch_id)`` over a stream; wait if it ends by itself."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    if trigger.get("availableNow"):
        query.awaitTermination()
    return query


def staging(checkpoint: str) -> str:
    """Inside of a stream's progress, so that a renewed progress doesn't find old batches."""
    return f"{checkpoint}/staged-batches"


def statistics_upsert(
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = STATISTICS_PARTITIONS,
    as_of: datetime | None = None,
    newest_first: Sequence[str] = (INGESTED_AT,),
    loads: list[dict[str, int]] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch handler that merges raw statistics rows into clean_statistics.

    The newest row of a video-day wins, however late it arrives. The days touched are recorded for the report tables. The partition columns have
    to be part of the key; with the day among them, a batch rewrites the days it touches and
    not whole regions. ``loads`` gains the counts of each batch.
    """

    def resolve(rows: DataFrame) -> DataFrame:
        return latest_statistics(rows, newest_first)

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = None if loads is None else LoadCounts()
        new = build_silver_statistics(batch, as_of=as_of, newest_first=newest_first, counts=counts)
        note = None if counts is None else lambda: loads.append(counts.values())
        arrived = merge_partitions(new, path, partition_by, resolve, staging(checkpoint), batch_id, note, settled=True)
        # After publishing: a batch that died before is made again, and leaves its record then.
        record_touched(arrived, checkpoint, batch_id)

    return handle


def load_new_statistics(
    spark: SparkSession,
    raw: str,
    path: str,
    checkpoint: str,
    max_files: int = 10_000,
    trigger: Trigger = ALL_NEW_FILES,
    as_of: datetime | None = None,
    bulk: bool = True,
    folders: Sequence[str] = LANDING_FOLDERS,
    layout: str = "files",
    multi_line: bool = True,
    regions: Sequence[str] | None = None,
    loads: list[dict[str, int]] | None = None,
) -> None:
    """Take new raw files of all kinds into clean_statistics, one kind after the other, as
    they write the same table. Files of regions other than ``regions``, if given, count as seen.
    ``loads`` gains the counts of each batch."""

    def reader():
        return spark.readStream.options(**ANY_AGE).option("maxFilesPerTrigger", max_files)

    documents = load_documents(reader(), raw, video_files(folders), folders, layout)
    streams = {"documents": video_rows(only_regions(documents, regions))}
    if bulk:
        streams["bulk"] = only_regions(load_bulk(reader(), raw, multi_line), regions)
    for kind, stream in streams.items():
        progress = f"{checkpoint}/{kind}"
        run_batches(stream, statistics_upsert(path, progress, as_of=as_of, loads=loads), progress, trigger)


def load_new_reference(
    spark: SparkSession,
    raw: str,
    path: str,
    checkpoint: str,
    max_files: int = 10_000,
    trigger: Trigger = ALL_NEW_FILES,
    as_of: datetime | None = None,
    layout: str = "files",
) -> None:
    """Take new category files into clean_reference_data. As in a full build the newest document of a
    region stands for it, so an older one that arrives later changes nothing. Fields that the schema doesn't name are
    looked for once, among the files that are there when the stream starts, and become columns."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        new = build_silver_reference(category_items(batch), as_of)
        merge_partitions(new, path, ("region",), newest_document, staging(checkpoint), batch_id)

    reader = spark.readStream.options(**ANY_AGE).option("maxFilesPerTrigger", max_files)
    stream = load_documents(reader, raw, category_schema(spark, raw, layout), None, layout)
    run_batches(with_region(stream), handle, checkpoint, trigger)


def first_of_video_day(
    stream: DataFrame, event_time: str = INGESTED_AT, delay: str = "2 days"
) -> DataFrame:
    """For a stream that is passed on row by row: the first row of each video, region and day,
    with state kept for ``delay`` only. A table that shall hold the latest row is kept by
    :func:`statistics_upsert`."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(
        list(schemas.VIDEO_DAY_KEY)
    )
