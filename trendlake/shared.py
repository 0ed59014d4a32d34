"""The folder all executors share, and writing intermediate tables there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or set on the context).

    Only a local session may fall back to a folder of its own; on a cluster an unset
    folder is an error, because a machine-local one is lost with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="trendlake-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own for one run, below the shared folder."""
    return f"{shared_root(spark)}/trendlake/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint and survives lost executors, but stays columnar, so
    several readers each fetch only their own columns. Zstandard works within the heap; many small
    files of other codecs pile up buffers outside of it. ``options`` go to the Parquet writer.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
