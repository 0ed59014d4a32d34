"""Catalog tables: whole, pruned by region, optional, or a bounded sample."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(
    spark: SparkSession, name: str, regions: Iterable[str] | None = None
) -> DataFrame:
    """A table, or only the partitions of the given regions."""
    return only_regions(spark.table(name), regions)


def only_regions(df: DataFrame, regions: Iterable[str] | None) -> DataFrame:
    """Rows of the given regions, in any spelling. The filter is on the partition column alone, so
    Spark skips the other folders."""
    if regions is None:
        return df
    wanted = {region.strip().lower() for region in regions}
    return df.filter(F.lower(F.trim("region")).isin(*sorted(wanted)))


def other_regions(df: DataFrame, regions: Iterable[str]) -> DataFrame:
    """Rows that :func:`only_regions` leaves out, also by the partition column alone."""
    wanted = {region.strip().lower() for region in regions}
    return df.filter(~F.coalesce(F.lower(F.trim("region")).isin(*sorted(wanted)), F.lit(False)))


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table, or None if the catalog has none of that name. Other errors are raised."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def sample_table(spark: SparkSession, name: str, rows: int) -> DataFrame:
    """A bounded, unordered sample, for a quick look."""
    return spark.table(name).limit(rows)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folders written over time, with the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(path)
