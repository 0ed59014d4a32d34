"""Raw statistics: bulk CSV files and API documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.schemas import CORRUPT, INGESTED_AT
from trendlake.sources.documents import (
    BULK_KINDS,
    FILE_TIME,
    LANDING_FOLDERS,
    Watch,
    below,
    empty,
    file_pattern,
    join_schemas,
    load_if_any,
    read_documents,
)

BULK_FILES = join_schemas(schemas.BULK_CSV, schemas.REGION_PARTITION)
BULK_GLOB = file_pattern(BULK_KINDS)


def video_files(folders: Sequence[str]) -> T.StructType:
    """API documents with the partition columns of their folders, of declared types."""
    partitions = [schemas.LANDING_PARTITIONS[name] for name in folders]
    return join_schemas(schemas.VIDEO_DOCUMENT, T.StructType(partitions))


def load_bulk(reader, path: str, multi_line: bool = True) -> DataFrame:
    """Bulk CSV in ``region=..`` folders through a batch or stream reader, dated by file: a
    later upload of the same video-day wins.

    Quoted text may hold line breaks, which makes a file one task; ``multi_line=False``
    splits large files that are known to have none.
    """
    reader = (
        reader.format("csv")
        .schema(BULK_FILES)
        .option("header", True)
        .option("enforceSchema", False)  # columns in another order are an error
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("basePath", path)
    )
    loaded = load_if_any(reader, f"{below(path, ['region'])}/{BULK_GLOB}")
    if loaded is None:
        return empty(join_schemas(BULK_FILES, schemas.struct(_ingested_at=schemas.TIME)))
    return loaded.withColumn(INGESTED_AT, F.col("_metadata.file_modification_time"))


def read_stats_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Bulk CSV, plain or compressed, in ``region=..`` folders. What lies elsewhere isn't read;
    :func:`~trendlake.sources.documents.misplaced_files` lists it."""
    return load_bulk(spark.read, path, multi_line)


def read_video_documents(
    spark: SparkSession,
    path: str,
    folders: Sequence[str] = LANDING_FOLDERS,
    layout: str = "files",
    watch: Watch | None = None,
) -> DataFrame:
    """Whole API documents below ``region=../date=../hour=..`` folders."""
    return read_documents(spark, path, video_files(folders), folders, layout, watch=watch)


def read_document_sizes(
    spark: SparkSession,
    path: str,
    folders: Sequence[str] = LANDING_FOLDERS,
    layout: str = "files",
    files: Sequence[str] | None = None,
) -> DataFrame:
    """As :func:`read_video_documents`, or of some files only, but of each item the id only: for counting documents and their items."""
    ids = T.ArrayType(schemas.struct(id=schemas.TEXT))
    fields = [T.StructField(f.name, ids) if f.name == "items" else f for f in video_files(folders)]
    return read_documents(spark, path, T.StructType(fields), folders, layout, files)


def silver_columns(documents: DataFrame) -> DataFrame:
    """Of whole documents what :func:`video_rows` and the counts need: what is observed behind it passes no column that isn't used."""
    landed = F.struct(F.col("_pipeline_metadata.ingestion_timestamp")).alias("_pipeline_metadata")
    return documents.select("region", "items", landed, CORRUPT, FILE_TIME)


def video_rows(documents: DataFrame) -> DataFrame:
    """One row per video of the API documents, dated by the envelope."""
    landed = F.try_to_timestamp(F.col("_pipeline_metadata.ingestion_timestamp"))
    if FILE_TIME in documents.columns:
        landed = F.coalesce(landed, F.col(FILE_TIME))
    return documents.select(
        "region", landed.alias(INGESTED_AT), F.explode("items").alias("video")
    ).select("video.*", "region", INGESTED_AT)


def read_stats_json(
    spark: SparkSession,
    path: str,
    folders: Sequence[str] = LANDING_FOLDERS,
    layout: str = "files",
) -> DataFrame:
    """Videos of the API documents below ``path``."""
    return video_rows(read_video_documents(spark, path, folders, layout))
