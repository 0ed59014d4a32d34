from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.files import category, csv_line, put_categories, put_csv, put_document, video
from trendlake.schemas import CLEAN_STATISTICS
from trendlake.sinks.tables import write_partitions
from trendlake.streaming import upsert
from trendlake.streaming.incremental import (
    first_of_video_day,
    load_new_reference,
    load_new_statistics,
)
from trendlake.streaming.upsert import merge_partitions, only_partitions


@pytest.fixture
def lake(spark, tmp_path, noon):
    class Lake:
        raw = tmp_path / "raw"
        clean = str(tmp_path / "clean")

        def load(self):
            load_new_statistics(
                spark, str(self.raw), self.clean, str(tmp_path / "progress"), as_of=noon
            )

        def rows(self, *columns):
            return rows(spark.read.schema(CLEAN_STATISTICS).parquet(self.clean), *columns)

        def files(self):
            return {
                str(f): f.stat().st_mtime_ns
                for f in (tmp_path / "clean").rglob("part-*.parquet")
            }

    lake = Lake()
    lake.raw.mkdir()
    return lake


def test_second_run_takes_only_new_files(lake):
    put_document(lake.raw, "us", video("v1"), video("v2"))
    put_csv(lake.raw, "gb", csv_line("v3"))
    lake.load()
    first = lake.rows("video_id", "region", "views", "trending_date_parsed")
    assert [r[:3] for r in first] == [("v1", "us", 100), ("v2", "us", 100), ("v3", "gb", 100)]
    files = lake.files()
    lake.load()
    assert lake.files() == files
    put_document(lake.raw, "fr", video("v9"))
    lake.load()
    assert len(lake.rows()) == 4
    assert files.items() <= lake.files().items()


def test_newer_row_wins_and_late_older_row_does_not(lake):
    put_document(lake.raw, "us", video("v1", views="200"), at="2024-03-01T10:00:00+00:00", name="b")
    lake.load()
    put_document(lake.raw, "us", video("v1", views="100"), at="2024-03-01T09:00:00+00:00", name="a")
    put_document(lake.raw, "us", video("v2"), at="2024-03-01T09:00:00+00:00", name="a2")
    lake.load()
    assert lake.rows("video_id", "views") == [("v1", 200), ("v2", 100)]
    put_document(lake.raw, "us", video("v1", views="300"), at="2024-03-01T11:00:00+00:00", name="c")
    lake.load()
    assert lake.rows("video_id", "views") == [("v1", 300), ("v2", 100)]


def batch(spark, *data):
    return spark.createDataFrame(data, "k string, v int, region string, day int")


def latest(df):
    return df.groupBy("k", "region", "day").agg(F.max("v").alias("v")).select("k", "v", "region", "day")


def test_retried_batch_publishes_the_staged_rows(spark, tmp_path, monkeypatch):
    """Publishing fails after the old partition is gone: the retry still has its rows."""
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")

    def merge(df, number):
        merge_partitions(df, path, ("region", "day"), latest, stage, number)

    merge(batch(spark, ("a", 1, "us", 1), ("b", 1, "us", 2)), 0)
    real = upsert.write_partitions

    def lose_table(df, target, by, **options):
        if target != path:
            return real(df, target, by, **options)
        real(df.limit(0).unionByName(batch(spark, ("lost", 0, "us", 1))), target, by)
        raise RuntimeError("executor gone")

    monkeypatch.setattr(upsert, "write_partitions", lose_table)
    new = batch(spark, ("c", 5, "us", 1))
    with pytest.raises(RuntimeError):
        merge(new, 1)
    monkeypatch.setattr(upsert, "write_partitions", real)
    merge(new, 1)
    assert rows(spark.read.parquet(path)) == [("a", 1, "us", 1), ("b", 1, "us", 2), ("c", 5, "us", 1)]


def test_first_batch_is_staged_in_its_partitions_and_published_again(spark, tmp_path, monkeypatch):
    """Where there is no table yet settled rows aren't merged with anything, also if publishing them has to be repeated."""
    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    real, resolved = upsert.write_partitions, []

    def resolve(df):
        resolved.append(df)
        return latest(df)

    def merge(df, number):
        return merge_partitions(df, path, ("region", "day"), resolve, stage, number, settled=True)

    def lose_rows(df, target, by, **options):
        real(df.limit(1) if target == path else df, target, by, **options)
        if target == path:
            raise RuntimeError("executor gone")

    first = batch(spark, ("a", 1, "us", 1), ("b", 1, "us", 2), ("c", 1, None, None))
    monkeypatch.setattr(upsert, "write_partitions", lose_rows)
    with pytest.raises(RuntimeError):
        merge(first, 0)
    monkeypatch.setattr(upsert, "write_partitions", real)
    assert rows(merge(first, 0)) == rows(first)
    assert not resolved
    assert rows(spark.read.schema(first.schema).parquet(path)) == rows(first)
    merge(batch(spark, ("a", 5, "us", 1), ("d", 1, "gb", 1)), 1)
    merge(batch(spark, ("e", 1, "gb", 1)), 2)
    assert len(resolved) == 2
    got = rows(spark.read.schema(first.schema).parquet(path), "k", "v")
    assert got == [("a", 5), ("b", 1), ("c", 1), ("d", 1), ("e", 1)]


def test_touched_partitions(spark):
    stored = batch(spark, ("a", 1, "us", 1), ("b", 1, "us", None), ("c", 1, None, 1), ("d", 1, "gb", 1))
    touched = batch(spark, ("x", 0, "us", None), ("x", 0, None, 1), ("x", 0, "gb", 2))
    assert rows(only_partitions(stored, touched, ("region", "day")), "k") == [("b",), ("c",)]


def test_many_touched_partitions(spark):
    many = spark.range(5000).select(F.col("id").cast("string").alias("region"), F.lit(1).alias("day"))
    stored = many.withColumn("k", F.col("region"))
    assert only_partitions(stored, many.filter("region < '5'"), ("region", "day")).count() == many.filter("region < '5'").count()


def test_merge_keeps_columns_that_only_the_table_has(spark, tmp_path):
    path = str(tmp_path / "t")
    batch(spark, ("a", 1, "us", 1)).withColumn("note", F.lit("n")).write.partitionBy("region", "day").parquet(path)
    merge_partitions(batch(spark, ("b", 2, "us", 1)), path, ("region", "day"), lambda df: df, f"{path}-stage", 0)
    got = spark.read.option("mergeSchema", True).parquet(path)
    assert rows(got, "k", "v", "note") == [("a", 1, "n"), ("b", 2, None)]


def test_files_of_any_age_and_order(spark, tmp_path, noon):
    """Newest first, thirty days apart, over two runs."""
    raw, clean = tmp_path / "raw", str(tmp_path / "clean")
    now = 1_709_280_000
    for run in ((0, 1), (2, 3, 40)):
        for age in run:
            name = put_document(raw, "us", video(f"v{age}"), name=f"d{age}")
            os.utime(name, (now - age * 30 * 86_400,) * 2)
        load_new_statistics(spark, str(raw), clean, str(tmp_path / "progress"), as_of=noon)
    got = rows(spark.read.schema(CLEAN_STATISTICS).parquet(clean), "video_id")
    assert got == [("v0",), ("v1",), ("v2",), ("v3",), ("v40",)]


def test_only_some_regions(spark, tmp_path, noon):
    raw, clean = tmp_path / "raw", str(tmp_path / "clean")
    put_document(raw, "US", video("v1"))
    put_document(raw, "gb", video("v2"))
    load_new_statistics(spark, str(raw), clean, str(tmp_path / "p"), as_of=noon, regions=["us"])
    assert rows(spark.read.schema(CLEAN_STATISTICS).parquet(clean), "video_id") == [("v1",)]


def test_older_reference_file_does_not_win(spark, tmp_path, noon):
    raw, clean = tmp_path / "raw", str(tmp_path / "clean")
    for name, title, at in (("b.json", "new", 1_709_280_000), ("a.json", "old", 1_709_280_000 - 86_400 * 20)):
        os.utime(put_categories(raw, "us", category("1", title), name=name), (at, at))
        load_new_reference(spark, str(raw), clean, str(tmp_path / "progress"), as_of=noon)
    assert rows(spark.read.parquet(clean), "id", "snippet_title") == [("1", "new")]


def test_reference_files_replace_their_region(spark, tmp_path, noon):
    raw, clean = tmp_path / "raw", str(tmp_path / "clean")

    def load():
        load_new_reference(spark, str(raw), clean, str(tmp_path / "progress"), as_of=noon)
        return rows(spark.read.parquet(clean), "region", "id", "snippet_title")

    put_categories(raw, "us", category("1", "a"), category("2", "b"))
    put_categories(raw, "gb", category("1", "a"))
    assert load() == [("gb", "1", "a"), ("us", "1", "a"), ("us", "2", "b")]
    assert load() == [("gb", "1", "a"), ("us", "1", "a"), ("us", "2", "b")]
    new = put_categories(raw, "us", category("1", "new"), name="newer.json")
    os.utime(new, (4_000_000_000, 4_000_000_000))
    assert load() == [("gb", "1", "a"), ("us", "1", "new")]


def test_first_of_video_day(spark, tmp_path):
    at = datetime(2024, 3, 1)
    data = [("v1", "us", at.date(), at + timedelta(hours=h), h) for h in range(3)]
    data.append(("v2", "us", at.date(), at, 9))
    schema = "video_id string, region string, trending_date_parsed date, _ingested_at timestamp, n int"
    source = str(tmp_path / "in")
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(source)
    stream = first_of_video_day(spark.readStream.schema(schema).parquet(source))
    query = (
        stream.writeStream.format("memory").queryName("firsts").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("firsts"), "video_id") == [("v1",), ("v2",)]


def test_upsert_opens_files_of_touched_partitions_only(spark, tmp_path):
    """Partitions with odd names and a column of their own are merged; a file that can't be read lies in another one."""
    path, places = str(tmp_path / "table"), ["a b", "a%c", "x[1]", "cé:/", None]
    old = spark.createDataFrame([(r, i, "old", "kept") for r in places for i in range(3)], "region string, id int, v string, more string")
    write_partitions(old, path)
    broken = tmp_path / "table" / "region=zz" / "part-0.parquet"
    broken.parent.mkdir()
    broken.write_bytes(b"not parquet")
    new = spark.createDataFrame([(r, 2, "new") for r in places] + [("b", 9, "new")], "region string, id int, v string")

    def resolve(df):
        return df.groupBy("region", "id").agg(F.min("v").alias("v"), F.max("more").alias("more") if "more" in df.columns else F.lit(None).cast("string").alias("more"))

    merge_partitions(new, path, ("region",), resolve, str(tmp_path / "stage"), 0)
    broken.unlink()
    got = spark.read.schema(old.schema).parquet(path)
    expected = [(r, i, "new" if i == 2 else "old", "kept") for r in places for i in range(3)] + [("b", 9, "new", None)]
    assert sorted(map(tuple, got.select("region", "id", "v", "more").collect()), key=repr) == sorted(expected, key=repr)
