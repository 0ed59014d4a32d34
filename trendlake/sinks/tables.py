"""Partitioned Parquet tables, replaced partition by partition, and the raw landing zone."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.sources.documents import LANDING_FOLDERS


def count_on_write(df: DataFrame, *metrics) -> tuple[DataFrame, Observation]:
    """Count rows (and more) while they are written, without a job of their own.

    A stage that is run again after an executor loss may be counted twice: use the numbers
    for the log, and :func:`stored_rows` where they must be exact.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def stored_rows(spark: SparkSession, path: str) -> int:
    """Exact number of stored rows; Parquet answers it from the file footers."""
    return spark.read.parquet(path).count()


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    mode: str = "overwrite",
    rebalance: bool = True,
    whole: bool = False,
) -> None:
    """Write Snappy Parquet folders. ``overwrite`` replaces only the partitions in ``df``,
    so running a job again doesn't double its rows; with ``whole`` it replaces the table, so that
    partitions that ``df`` lacks are gone. ``append`` adds files.

    ``rebalance`` brings a partition's rows together before writing, and splits a partition
    that is much larger than others over several tasks, instead of putting it in one. Leave
    it off for results whose tasks are already large: it costs one more shuffle.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    (
        df.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


# What is known of a replacement: its rows once they are staged in full, and whether they are published.
NOTE = "rows long, published boolean, partition_by array<string>"


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}__replacement"


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("region",)) -> int:
    """Replace the whole table at ``path`` by ``df``, so that a failure doesn't lose it; the rows written.

    The new rows are written beside the table and counted first: until that is done the old ones stay as they are. Then they are
    published and counted again. If publishing is cut short, the staged rows are complete, and
    :func:`finish_replacement`, or the next replacement, puts the table right. In a catalog :func:`switch_table` does
    without publishing.
    """
    spark, staged = df.sparkSession, _staged(path)
    _note(spark, staged, -1, partition_by)
    write_partitions(df, f"{staged}/rows", partition_by, whole=True)
    stored = spark.read.schema(df.schema).parquet(f"{staged}/rows")
    _note(spark, staged, stored.count(), partition_by)
    return _publish(stored, path, partition_by, staged)


def _note(spark: SparkSession, staged: str, rows: int, partition_by: Sequence[str]) -> None:
    noted = spark.createDataFrame([(rows, rows < 0, list(partition_by))], NOTE)
    noted.coalesce(1).write.mode("overwrite").json(f"{staged}/note")


def _publish(stored: DataFrame, path: str, partition_by: Sequence[str], staged: str) -> int:
    spark = stored.sparkSession
    # Brought together when staged: publishing needs no shuffle.
    write_partitions(stored, path, partition_by, rebalance=False, whole=True)
    wanted = stored.count()
    found = spark.read.schema(stored.schema).parquet(path).count()
    if found != wanted:
        raise OSError(f"{path} holds {found} rows of {wanted}; the complete ones are in {staged}")
    _note(spark, staged, -1, partition_by)
    return found


def finish_replacement(spark: SparkSession, path: str) -> bool:
    """Publish what a replacement that was cut short has staged in full; whether there was any."""
    staged = _staged(path)
    try:
        note = spark.read.schema(NOTE).json(f"{staged}/note").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    if note is None or note.published:
        return False
    # Partition values as text, so that they are written as they were.
    found = spark.read.parquet(f"{staged}/rows").schema
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in note.partition_by else f.dataType) for f in found])
    stored = spark.read.schema(schema).parquet(f"{staged}/rows")
    if stored.count() != note.rows:
        return False
    _publish(stored, path, note.partition_by, staged)
    return True


def create_external(
    spark: SparkSession, name: str, schema: T.StructType, path: str, partition_by: Sequence[str]
) -> None:
    """A catalog table over folders that exist, with declared types: a partition value like 01 stays text."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}')"
        f" PARTITIONED BY ({', '.join(partition_by)})"
    )
    spark.catalog.recoverPartitions(name)


def switch_table(df: DataFrame, name: str, partition_by: Sequence[str] = ("region",)) -> str:
    """Replace a catalog table by ``df``; the new folder.

    The rows are written to a new folder beside the table's, registered under another name and counted there; until then a failure
    leaves the table as it is. Then the two names are switched in the catalog, without moving rows. The table as it
    was stays as ``name__before``, for readers that are under way and for a way back, until the next switch. (Setting a new location
    for the old entry isn't enough: partitions of the catalog keep the location they were added with.)
    """
    spark = df.sparkSession
    folder = table_location(spark, name).rstrip("/").rsplit("/", 1)[0]
    path = f"{folder}/{name.rsplit('.', 1)[-1]}-{uuid.uuid4().hex}"
    before, coming = f"{name}__before", f"{name}__coming"
    counted, seen = count_on_write(df)
    write_partitions(counted, path, partition_by, whole=True)
    spark.sql(f"DROP TABLE IF EXISTS {coming}")
    create_external(spark, coming, df.schema, path, partition_by)
    # A stage that ran twice is counted twice, never less than once.
    rows, written = spark.table(coming).count(), seen.get["rows"]
    if rows > written or (written and not rows):
        raise OSError(f"{path} holds {rows} rows of {written}; {name} is unchanged")
    spark.sql(f"DROP TABLE IF EXISTS {before}")
    spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
    spark.sql(f"ALTER TABLE {coming} RENAME TO {name}")
    return path


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = ("region",),
    mode: str = "overwrite",
    path: str | None = None,
    rebalance: bool = True,
) -> None:
    """Write to a catalog table, creating it on first use.

    An existing table gains columns it doesn't have yet; columns it has and ``df`` lacks are
    read as NULL. ``mode`` works as in :func:`write_partitions`.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        new = df.hint("rebalance", *partition_by) if rebalance else df
        writer = new.write.format("parquet").option("compression", "snappy")
        if path is not None:
            writer = writer.option("path", path)
        writer.partitionBy(*partition_by).saveAsTable(name)
        return
    known = set(spark.table(name).columns)
    added = [field for field in df.schema.fields if field.name not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    write_partitions(df, table_location(spark, name), partition_by, mode, rebalance)
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def land_raw(
    documents: DataFrame,
    path: str,
    partition_by: Sequence[str] = LANDING_FOLDERS,
    mode: str = "append",
) -> None:
    """Land documents, one per line, under folders taken from their envelope.

    Lines, unlike one indented document per file, can be split over tasks when read.
    """
    landed = F.to_timestamp("_pipeline_metadata.ingestion_timestamp")
    folders = {
        "region": F.col("_pipeline_metadata.region"),
        "date": landed.cast("date"),
        "hour": F.date_format(landed, "HH"),
    }
    placed = documents.withColumns({name: folders[name] for name in partition_by})
    if "region" not in partition_by:
        placed = placed.drop("region")
    placed.write.mode(mode).partitionBy(*partition_by).json(path)
