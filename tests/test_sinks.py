from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import rows
from trendlake import shared
from trendlake.sinks.tables import (
    count_on_write,
    stored_rows,
    write_partitions,
    write_table,
)


def frame(spark, data, schema="x bigint, region string"):
    return spark.createDataFrame(data, schema)


def test_overwrite_replaces_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(frame(spark, [(1, "us"), (2, "gb")]), path)
    write_partitions(frame(spark, [(3, "us")]), path)
    write_partitions(frame(spark, [(3, "us")]), path)
    assert rows(spark.read.parquet(path)) == [(2, "gb"), (3, "us")]
    write_partitions(frame(spark, [(4, "us")]), path, mode="append")
    assert stored_rows(spark, path) == 3


def test_columns_may_be_added(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(frame(spark, [(1, "us")]), path)
    write_partitions(frame(spark, [(2, "n", "gb")], "x bigint, y string, region string"), path)
    merged = spark.read.option("mergeSchema", True).parquet(path)
    assert rows(merged, "x", "y", "region") == [(1, None, "us"), (2, "n", "gb")]


def test_hot_partition_is_split_over_files(spark, tmp_path):
    """One partition with most rows isn't written by one task."""
    path = str(tmp_path / "t")
    df = spark.range(300_000).select(
        F.expr("repeat(uuid(), 3)").alias("x"),
        F.when(F.col("id") % 10 < 9, "us").otherwise("gb").alias("region"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "4m")
        write_partitions(df, path)
    finally:
        spark.conf.set(key, before)
    files = {r["region"]: r["n"] for r in spark.read.parquet(path).groupBy("region").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("n")).collect()}
    assert files["us"] > files["gb"] >= 1


def test_catalog_table_grows_and_is_replaced_by_partition(spark, tmp_path):
    name = "grown"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_table(frame(spark, [(1, "us"), (2, "gb")]), name, path=str(tmp_path / "g"))
    write_table(frame(spark, [(3, "us")]), name)
    assert rows(spark.table(name)) == [(2, "gb"), (3, "us")]
    write_table(frame(spark, [(4, "n", "fr")], "x bigint, y string, region string"), name)
    assert rows(spark.table(name), "x", "y", "region") == [
        (2, None, "gb"), (3, None, "us"), (4, "n", "fr")
    ]


def test_count_on_write(spark, tmp_path):
    df, seen = count_on_write(
        frame(spark, [(1, "us"), (-2, "gb")]), F.count_if(F.col("x") < 0).alias("negative")
    )
    write_partitions(df, str(tmp_path / "t"))
    assert seen.get == {"rows": 2, "negative": 1}


def test_materialize_uses_the_shared_folder(spark):
    stored = shared.materialize(spark.range(5), "test")
    assert stored.count() == 5
    assert shared.shared_root(spark) in stored.inputFiles()[0]
