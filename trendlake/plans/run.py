"""The whole run: land, build both silver tables, check, and build reports if checks passed."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.operators.categories import category_lookup
from trendlake.operators.cleanse import row_warnings
from trendlake.operators.counts import DocumentCounts, LoadCounts, total_counts
from trendlake.operators.documents import (
    COUNTS,
    expected_regions,
    file_summary,
    landed_counts,
    region_outcomes,
    summary_of_counts,
)
from trendlake.operators.quality import (
    DEFAULT_RULES,
    QualityRules,
    of_run,
    require_quality,
    run_checks,
)
from trendlake.plans.maintenance import BASE, maintain_gold, rebuild_gold, statistics_checkpoints
from trendlake.plans.silver import (
    build_silver_reference,
    build_silver_statistics,
    require_items,
)
from trendlake.sinks.tables import (
    create_external,
    finish_replacement,
    land_raw,
    replace_table,
    stored_rows,
    table_location,
    write_partitions,
)
from trendlake.sources.categories import category_items, read_category_documents
from trendlake.shared import materialize
from trendlake.sources.documents import FILE_SIZE, FILE_TIME, LANDING_FOLDERS, SOURCE_FILE, document_files, misplaced_files
from trendlake.sources.statistics import (
    read_document_sizes,
    read_stats_csv,
    read_stats_json,
    read_video_documents,
    silver_columns,
    video_rows,
)
from trendlake.sources.tables import only_regions, other_regions
from trendlake.streaming.incremental import (
    STATISTICS_PARTITIONS,
    load_new_reference,
    load_new_statistics,
)
from trendlake.streaming.upsert import PATTERN_SIGNS, is_stored, read_if_there


#: What tells a file from an earlier one of its name, and the counts kept of it.
FILE_KEY = (SOURCE_FILE, FILE_TIME, FILE_SIZE)
FILE_COUNTS = schemas.struct(
    _source_file=schemas.TEXT, _file_time=schemas.TIME, _file_size=schemas.LONG, region=schemas.TEXT,
    **dict.fromkeys(COUNTS, schemas.LONG),
)
GOLD = ("trending_analytics", "channel_analytics", "category_analytics")
TABLES = (
    "clean_statistics",
    "clean_reference_data",
    *GOLD,
    "quality_checks",
    "quality_history",
    "run_counts",
    "ingest_summary",
    "file_summary",
    "misplaced_files",
    "row_warnings",
)


@dataclass(frozen=True)
class Lake:
    """Where the tables lie below one root folder, and how landed documents are filed.

    ``layout`` is ``lines`` for raw trees of documents that hold one per line throughout, and
    ``multi_line`` is off for bulk CSV without line breaks in quotes: such files are split over tasks.
    """

    root: str
    landing: Sequence[str] = LANDING_FOLDERS
    layout: str = "files"
    multi_line: bool = True

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def raw_statistics(self) -> str:
        return self.path("raw_statistics")

    @property
    def raw_reference(self) -> str:
        return self.path("raw_statistics_reference_data")

    @property
    def statistics(self) -> str:
        return self.path("clean_statistics")

    @property
    def reference(self) -> str:
        return self.path("clean_reference_data")


@dataclass(frozen=True)
class RunReport:
    ingest: DataFrame
    files: DataFrame
    outcomes: DataFrame
    checks: DataFrame
    rows: Mapping[str, int]
    misplaced: DataFrame | None = None
    warnings: DataFrame | None = None
    counts: DataFrame | None = None
    history: DataFrame | None = None


def refresh_silver(
    spark: SparkSession,
    lake: Lake,
    regions: Sequence[str] | None = None,
    as_of: datetime | None = None,
    documents: DocumentCounts | None = None,
) -> list[dict[str, int]]:
    """Build both silver tables from all raw files; what was counted while writing.

    Without any raw statistics nothing is written. With ``regions`` only days that their
    raw files hold are replaced; other days and regions stay as they are. ``documents``, of the same regions, counts
    the documents that are read.
    """
    items = category_items(read_category_documents(spark, lake.raw_reference))
    reference = build_silver_reference(require_items(items), as_of)
    replace_table(reference, lake.reference)
    raw = [
        only_regions(df, regions)
        for df in (
            read_stats_csv(spark, lake.raw_statistics, lake.multi_line),
            read_stats_json(spark, lake.raw_statistics, lake.landing, lake.layout),
        )
    ]
    # A limited frame's first row is looked for in one task, then in more; isEmpty() would start all of them.
    if not any(df.select(F.lit(1)).head(1) for df in raw):
        return []
    counts = LoadCounts()
    if documents is not None:
        watched = read_video_documents(spark, lake.raw_statistics, lake.landing, lake.layout, documents.files)
        raw[1] = video_rows(documents.documents(silver_columns(only_regions(watched, regions))))
    statistics = build_silver_statistics(*raw, as_of=as_of, counts=counts)
    if regions is None:
        replace_table(statistics, lake.statistics, STATISTICS_PARTITIONS)
    else:
        write_partitions(statistics, lake.statistics, STATISTICS_PARTITIONS)
    return [counts.values()]


def update_silver(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    as_of: datetime | None = None,
    regions: Sequence[str] | None = None,
) -> list[dict[str, int]]:
    """Take only new raw files into both silver tables, statistics of all regions or some; the counts of each batch."""
    loads: list[dict[str, int]] = []
    load_new_reference(
        spark,
        lake.raw_reference,
        lake.reference,
        f"{checkpoint}/reference",
        as_of=as_of,
    )
    load_new_statistics(
        spark,
        lake.raw_statistics,
        lake.statistics,
        f"{checkpoint}/statistics",
        as_of=as_of,
        folders=lake.landing,
        layout=lake.layout,
        multi_line=lake.multi_line,
        regions=regions,
        loads=loads,
    )
    return loads


def silver_frames(spark: SparkSession, lake: Lake) -> dict[str, DataFrame | None]:
    """Both silver tables with declared types, so that a partition value like 01 stays text;
    None for one that was never written."""
    return {
        "clean_statistics": read_if_there(spark, lake.statistics, schemas.CLEAN_STATISTICS),
        "clean_reference_data": read_if_there(spark, lake.reference, schemas.CLEAN_REFERENCE),
    }


def write_gold(
    spark: SparkSession, lake: Lake, as_of: datetime | None = None, checkpoint: str | None = None
) -> dict[str, int]:
    """Build and write the report tables; their stored row counts. With the ``checkpoint`` of an incremental load
    only what its new rows touched is built."""
    silver = silver_frames(spark, lake)
    lookup = category_lookup(silver["clean_reference_data"])
    if checkpoint is None:
        rebuild_gold(spark, lake.path, silver["clean_statistics"], lookup, as_of)
    else:
        progress = statistics_checkpoints(f"{checkpoint}/statistics")
        maintain_gold(spark, lake.path, silver["clean_statistics"], lookup, progress, as_of)
    return {name: stored_rows(spark, lake.path(name)) for name in GOLD}


def run_lake(
    spark: SparkSession,
    lake: Lake,
    regions: Sequence[str] = schemas.REGIONS,
    documents: Sequence[DataFrame] = (),
    category_documents: Sequence[DataFrame] = (),
    checkpoint: str | None = None,
    only_from: Sequence[str] | None = None,
    rules: QualityRules = DEFAULT_RULES,
    as_of: datetime | None = None,
    database: str | None = None,
) -> RunReport:
    """One run over a lake.

    New enveloped documents are landed first, if given. With a ``checkpoint`` folder only
    new raw files are taken in; otherwise silver is rebuilt. Either way ``only_from`` limits the
    regions. Checks and summaries are stored beside the tables. With a ``database`` all stored tables can be
    named in SQL. Reports are built only if all checks pass, otherwise
    :class:`~trendlake.operators.quality.QualityGateError` is raised. ``regions`` are those the
    ingest summary expects.
    """
    for table in (lake.statistics, lake.reference, lake.path(BASE), *map(lake.path, GOLD)):
        finish_replacement(spark, table)
    for landed in documents:
        land_raw(landed, lake.raw_statistics, lake.landing)
    for landed in category_documents:
        land_raw(landed, lake.raw_reference, partition_by=("region", "date"))
    seen = DocumentCounts(regions, only_from)
    if checkpoint is None:
        loads = refresh_silver(spark, lake, only_from, as_of, seen)
    else:
        loads = update_silver(spark, lake, checkpoint, as_of, only_from)
    counts = stored(lake, "run_counts", total_counts(spark, loads))
    expected = expected_regions(spark, regions)
    if checkpoint is None:
        ingest = summary_of_counts(counts_of_rebuild(spark, lake, seen, only_from), expected)
    else:
        ingest = summary_of_counts(counts_of_files(spark, lake, f"{checkpoint}/counted-files"), expected)
    files = file_summary(read_category_documents(spark, lake.raw_reference))
    silver = silver_frames(spark, lake)
    # Stored before the gate: they are what one needs if it closes.
    checks = stored(lake, "quality_checks", run_checks(spark, silver, rules, as_of))
    history = remembered(lake, "quality_history", of_run(checks, uuid.uuid4().hex, as_of))
    ingest, files = stored(lake, "ingest_summary", ingest), stored(lake, "file_summary", files)
    misplaced = stored(lake, "misplaced_files", misplaced_files(spark, lake.raw_statistics, lake.landing))
    warnings = None
    if silver["clean_statistics"] is not None:
        warnings = stored(lake, "row_warnings", row_warnings(silver["clean_statistics"]))
    if database is not None:
        register_tables(spark, lake, database)
    require_quality(checks)
    rows = write_gold(spark, lake, as_of, checkpoint)
    if database is not None:
        register_tables(spark, lake, database)
    return RunReport(
        ingest=ingest,
        files=files,
        outcomes=region_outcomes(ingest, files),
        checks=checks,
        rows=rows,
        misplaced=misplaced,
        warnings=warnings,
        counts=counts,
        history=history,
    )


def counts_of_rebuild(
    spark: SparkSession, lake: Lake, seen: DocumentCounts, only_from: Sequence[str] | None
) -> DataFrame:
    """The documents that lie in the raw folder, counted per region: as seen while silver was built from them, and by reading them
    for regions it wasn't built from, or for all if what was seen may not be exact."""
    found = seen.values(spark, lake.raw_statistics, lake.landing)
    if found is not None and only_from is None:
        return found
    documents = read_document_sizes(spark, lake.raw_statistics, lake.landing, lake.layout)
    if found is None:
        return landed_counts(documents)
    return landed_counts(other_regions(documents, only_from)).unionByName(found)


def counts_of_files(spark: SparkSession, lake: Lake, known: str) -> DataFrame:
    """The documents that lie in the raw folder now, counted per region.

    The counts of each file are kept at ``known``. A file is read if it isn't there with its present time and size, and its
    counts are left out while the file isn't in the raw folder. Names of files to be read, and nothing else, reach the driver,
    which lists them for a read in any case.
    """
    present = materialize(document_files(spark, lake.raw_statistics, lake.landing), "raw-files")
    before = read_if_there(spark, known, FILE_COUNTS)
    new, files = present, None
    if before is not None:
        new = present.join(before, list(FILE_KEY), "left_anti")
        files = [PATTERN_SIGNS.sub(r"\\\1", unquote(row[SOURCE_FILE])) for row in new.select(SOURCE_FILE).collect()]
    if files is None or files:
        sizes = read_document_sizes(spark, lake.raw_statistics, lake.landing, lake.layout, files)
        counted = new.join(landed_counts(sizes, (SOURCE_FILE, "region")), SOURCE_FILE, "left")
        # A file that holds no document has counts too. Nothing is replaced: a run that was cut short leaves what it has counted.
        counted.fillna(0, subset=list(COUNTS)).select(*FILE_COUNTS.names).write.mode("append").parquet(known)
    every = read_if_there(spark, known, FILE_COUNTS).dropDuplicates(list(FILE_KEY))
    there = every.join(present, list(FILE_KEY), "left_semi")
    return there.groupBy("region").agg(*(F.sum(name).alias(name) for name in COUNTS))


def stored(lake: Lake, name: str, report: DataFrame) -> DataFrame:
    """A report of the run, a few rows, written as a table of the lake and read back."""
    report.coalesce(1).write.mode("overwrite").parquet(lake.path(name))
    return report.sparkSession.read.schema(report.schema).parquet(lake.path(name))


def remembered(lake: Lake, name: str, report: DataFrame) -> DataFrame:
    """As :func:`stored`, beside the reports of earlier runs."""
    report.coalesce(1).write.mode("append").parquet(lake.path(name))
    return report.sparkSession.read.schema(report.schema).parquet(lake.path(name))


def _forget(spark: SparkSession, name: str, path: str) -> None:
    """Drop the catalog's entry of a table at ``path``. A table of that name elsewhere, or one that the catalog manages and
    would delete, is the user's."""
    if not spark.catalog.tableExists(name):
        return
    kind = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Type'").first()
    location = table_location(spark, name) if kind and kind["data_type"] == "EXTERNAL" else None
    if location is None or urlsplit(location).path.rstrip("/") != urlsplit(path).path.rstrip("/"):
        raise ValueError(f"{name} is a table of its own, not {path}; choose another database")
    spark.sql(f"DROP TABLE {name}")


def register_tables(spark: SparkSession, lake: Lake, database: str) -> list[str]:
    """Make the tables that are stored so far available to SQL as ``database.table``; their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table in TABLES:
        if not is_stored(spark, lake.path(table)):
            continue
        name = f"{database}.{table}"
        _forget(spark, name, lake.path(table))
        known = {"clean_statistics": schemas.CLEAN_STATISTICS, "clean_reference_data": schemas.CLEAN_REFERENCE}
        partitions = {"clean_statistics": STATISTICS_PARTITIONS}.get(table, ("region",))
        if table in known:
            columns = known[table]
            if table == "clean_reference_data":
                # Few rows in few files, which may have gained columns of their own.
                stored = spark.read.option("mergeSchema", True).parquet(lake.path(table)).schema
                columns = T.StructType([*columns.fields, *(f for f in stored.fields if f.name not in columns.names)])
            create_external(spark, name, columns, lake.path(table), partitions)
        else:
            spark.catalog.createTable(name, path=lake.path(table), source="parquet")
            if table in GOLD:
                spark.catalog.recoverPartitions(name)
        names.append(name)
    return names
