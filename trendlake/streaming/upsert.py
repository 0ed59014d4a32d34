"""Merging new rows into a partitioned table, so that a retried batch does no harm."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.sinks.tables import write_partitions

#: What a path pattern gives a meaning to; names of files are taken as they are.
PATTERN_SIGNS = re.compile(r"([\[\]{}*?\\])")

MARKER = T.StructType().add("batch", T.LongType()).add("folder", T.StringType())


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Parquet with the given schema, or None if the path doesn't exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def only_partitions(
    df: DataFrame, partitions: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Rows of the partitions that occur in ``partitions``, whatever their number.

    The join decides; the range of each column, one row in all, goes before it as a filter on
    partition columns, so that folders outside of it aren't read.
    """
    listed = partitions.select(*columns).distinct()
    bounds = listed.agg(
        *(F.min(name).alias(f"{name}_low") for name in columns),
        *(F.max(name).alias(f"{name}_high") for name in columns),
        *(F.coalesce(F.bool_or(F.col(name).isNull()), F.lit(False)).alias(f"{name}_none") for name in columns),
    ).first()
    for name in columns:
        within = F.col(name).between(F.lit(bounds[f"{name}_low"]), F.lit(bounds[f"{name}_high"]))
        df = df.filter(within | F.col(name).isNull() if bounds[f"{name}_none"] else within)
    renamed = listed.toDF(*(f"_{name}" for name in columns))
    same = F.lit(True)
    for name in columns:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return df.join(renamed, same, "left_semi")


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``; one footer tells."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def touched_rows(
    spark: SparkSession, path: str, schema: T.StructType, partitions: DataFrame, columns: Sequence[str]
) -> DataFrame | None:
    """The stored rows of the partitions that occur in ``partitions``, with the types of ``schema`` and all columns that their
    files have besides; None without any.

    Only the touched partitions' files are opened to learn their columns, so a batch doesn't cost more as the table's history
    grows. Their names, and nothing else, reach the driver, which lists them for a read in any case.
    """
    placed = read_if_there(spark, path, T.StructType([schema[name] for name in columns]))
    if placed is None:
        return None
    named = placed.select(*columns, F.col("_metadata.file_path").alias("_file"))
    found = only_partitions(named, partitions, columns).select("_file").distinct().collect()
    files = sorted(PATTERN_SIGNS.sub(r"\\\1", unquote(row["_file"])) for row in found)
    if not files:
        return None
    reader = spark.read.option("basePath", path)
    known = schema.fieldNames()
    more = [field for field in reader.option("mergeSchema", True).parquet(*files).schema.fields if field.name not in known]
    return spark.read.option("basePath", path).schema(T.StructType([*schema.fields, *more])).parquet(*files)


def merge_partitions(
    new: DataFrame,
    path: str,
    partition_by: Sequence[str],
    resolve: Callable[[DataFrame], DataFrame],
    stage: str,
    batch_id: int,
    arrived_now: Callable[[], None] | None = None,
    settled: bool = False,
) -> DataFrame:
    """Merge ``new`` into the partitions it touches; ``resolve`` settles rows of equal key.

    The merged partitions are written to a staging folder first and published from there. If
    publishing is cut short, the retried batch publishes the same staged rows again instead
    of merging with a half-replaced table. Two staging folders take turns, as only the last
    batch is ever retried. ``stage`` has to live and die with the progress that numbers the batches:
    keep it inside of the checkpoint folder. Columns that only the stored table has are kept.
    ``arrived_now`` is called once ``new`` is computed, which it isn't for a batch that is only published again.
    With ``settled`` no two rows of ``new`` have equal keys: where there is no table yet they are staged in its partitions at once,
    as there is nothing to merge with.
    Returns the rows of ``new``, as staged.
    """
    spark = new.sparkSession
    slot = f"{stage}/slot-{batch_id % 2}"
    folder = _staged_folder(spark, slot, batch_id)
    if folder is None:
        alone = settled and read_if_there(spark, path, new.schema) is None
        folder = "new" if alone else "merged"
        if alone:
            write_partitions(new, f"{slot}/new", partition_by, whole=True)
        else:
            new.write.mode("overwrite").parquet(f"{slot}/new")
        if arrived_now is not None:
            arrived_now()
        if not alone:
            arrived = spark.read.schema(new.schema).parquet(f"{slot}/new")
            stored = touched_rows(spark, path, new.schema, arrived, partition_by)
            merged = arrived if stored is None else stored.unionByName(arrived, allowMissingColumns=True)
            write_partitions(resolve(merged), f"{slot}/merged", partition_by, whole=True)
        _mark_staged(spark, slot, batch_id, folder)
    if is_stored(spark, f"{slot}/{folder}"):
        # All its files have the same columns, written by one job. Partition values keep their declared types.
        found = spark.read.parquet(f"{slot}/{folder}").schema
        more = [field for field in found.fields if field.name not in new.schema.fieldNames()]
        staged = spark.read.schema(T.StructType([*new.schema.fields, *more])).parquet(f"{slot}/{folder}")
        # Brought together when staged: publishing needs no shuffle.
        write_partitions(staged, path, partition_by, rebalance=False)
    return spark.read.schema(new.schema).parquet(f"{slot}/new")


def _staged_folder(spark: SparkSession, slot: str, batch_id: int) -> str | None:
    """The folder of the slot that holds what the batch publishes; None if the batch isn't staged."""
    marker = read_if_there(spark, f"{slot}/batch", MARKER)
    found = None if marker is None else marker.filter(F.col("batch") == batch_id).first()
    return None if found is None else found["folder"] or "merged"


def _mark_staged(spark: SparkSession, slot: str, batch_id: int, folder: str) -> None:
    marker = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"), F.lit(folder).alias("folder"))
    marker.write.mode("overwrite").parquet(f"{slot}/batch")
