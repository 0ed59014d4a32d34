"""Report tables by touched days, and replacements that can't lose a table."""

from __future__ import annotations

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_gold import NAMES, SCHEMA, some_stats
from trendlake.plans import gold, maintenance
from trendlake.plans.run import Lake, register_tables
from trendlake.sinks.tables import finish_replacement, replace_table, switch_table, table_location, write_partitions, write_table
from trendlake.streaming.upsert import read_if_there

TABLES = ("trending_analytics", "channel_analytics", "category_analytics")


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame(list(NAMES.items()), "category_id bigint, category_name string")


def tables(spark, paths):
    return {t: rows(spark.read.parquet(paths(t)).drop("_aggregated_at")) for t in TABLES}


def built_anew(stats, lookup):
    built = gold.build_gold(stats, lookup).tables()
    return {t: rows(df.drop("_aggregated_at").select(*_order(df))) for t, df in built.items()}


def _order(df):
    """Partition columns come last when read back."""
    return [c for c in df.columns if c not in ("region", "_aggregated_at")] + ["region"]


def changed(day, seed):
    """New rows of one day: other views, and a channel more."""
    for row in some_stats(90, seed):
        yield (row[0], "new" if row[5] % 7 == 0 else row[1], row[2], "us" if row[3] else None, day, *row[5:])


def test_touched_days_equal_a_full_build(spark, tmp_path, lookup, capsys):
    paths = Lake(str(tmp_path)).path
    progress = str(tmp_path / "progress")
    first = spark.createDataFrame(list(some_stats(500)), SCHEMA)
    write_partitions(first, paths("s"), gold.DAY)

    def stats():
        return read_if_there(spark, paths("s"), first.schema)

    assert maintenance.maintain_gold(spark, paths, stats(), lookup, [progress]) is False
    assert tables(spark, paths) == built_anew(stats(), lookup)
    for batch, day in enumerate((date(2024, 1, 2), None, date(2024, 1, 9))):
        new = spark.createDataFrame(list(changed(day, batch)), SCHEMA)
        write_partitions(new, paths("s"), gold.DAY)
        maintenance.record_touched(new, progress, batch)
        assert maintenance.maintain_gold(spark, paths, stats(), lookup, [progress]) is True
        assert tables(spark, paths) == built_anew(stats(), lookup)
    before = maintenance.read_state(spark, paths)
    assert before[progress] == 2
    assert maintenance.maintain_gold(spark, paths, stats(), lookup, [progress]) is True
    renamed = lookup.withColumn("category_name", F.concat("category_name", F.lit("!")))
    assert maintenance.maintain_gold(spark, paths, stats(), renamed, [progress]) is False
    assert tables(spark, paths) == built_anew(stats(), renamed)

    days = spark.createDataFrame([("us", date(2024, 1, 2))], "region string, trending_date_parsed date")
    capsys.readouterr()
    maintenance.touched_base(stats(), days).explain("formatted")
    filters = re.findall(r"PartitionFilters: \[([^\n]*)\]", capsys.readouterr().out)
    assert len(filters) == 1 and "(region" in filters[0] and ">= 2024-01-02" in filters[0] and "<= 2024-01-02" in filters[0]


def test_a_call_cut_short_can_be_made_again(spark, tmp_path, lookup, monkeypatch):
    paths, progress = Lake(str(tmp_path)).path, str(tmp_path / "progress")
    first = spark.createDataFrame(list(some_stats(200)), SCHEMA)
    write_partitions(first, paths("s"), gold.DAY)
    maintenance.maintain_gold(spark, paths, first, lookup, [progress])
    new = spark.createDataFrame(list(changed(date(2024, 1, 2), 5)), SCHEMA)
    write_partitions(new, paths("s"), gold.DAY)
    maintenance.record_touched(new, progress, 0)
    stats = read_if_there(spark, paths("s"), first.schema)
    real, calls = maintenance.write_partitions, []

    def failing(df, path, *args, **kwargs):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("lost")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(maintenance, "write_partitions", failing)
    with pytest.raises(OSError, match="lost"):
        maintenance.maintain_gold(spark, paths, stats, lookup, [progress])
    assert maintenance.maintain_gold(spark, paths, stats, lookup, [progress]) is True
    assert tables(spark, paths) == built_anew(stats, lookup)


def test_gold_scans_silver_twice(spark, tmp_path, plan, lookup):
    path = str(tmp_path / "s")
    spark.createDataFrame(list(some_stats(50)), SCHEMA).write.parquet(path)
    stats = spark.read.parquet(path)
    base, videos = gold.channel_category_days(stats), gold.channel_videos(stats)
    counts = [plan(df).split("== Physical Plan ==")[-1].count(f"{path}]") for df in (base, videos)]
    assert counts == [1, 1]
    stored = spark.createDataFrame(base.collect(), base.schema)
    for df in gold.gold_of(stored, spark.createDataFrame(videos.collect(), videos.schema), lookup).tables().values():
        assert path not in plan(df)


def test_sketch_instead_of_exact_videos(spark):
    stats = spark.createDataFrame(list(some_stats(600)), SCHEMA)
    exact = {r[0:2]: r[2] for r in map(tuple, gold.channel_videos(stats).collect())}
    near = {r[0:2]: r[2] for r in map(tuple, gold.channel_videos(stats, 0.02).collect())}
    assert exact.keys() == near.keys() and all(abs(near[k] - n) <= max(2, 0.1 * n) for k, n in exact.items())


def failing_rows(spark):
    return spark.range(0, 40, 1, 4).select(
        F.when(F.col("id") == 39, F.raise_error(F.lit("midway")).cast("bigint")).otherwise(F.col("id")).alias("x"), F.lit("us").alias("region")
    )


def test_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "us"), (2, "01")], "x bigint, region string")
    assert replace_table(old, path) == 2
    with pytest.raises(PySparkException):
        replace_table(failing_rows(spark), path)
    assert rows(spark.read.schema(old.schema).parquet(path)) == [(1, "us"), (2, "01")]
    assert finish_replacement(spark, path) is False
    assert finish_replacement(spark, str(tmp_path / "none")) is False


def test_publication_cut_short_is_finished(spark, tmp_path, monkeypatch):
    from trendlake.sinks import tables as sink

    path = str(tmp_path / "t")
    replace_table(spark.createDataFrame([(1, "us")], "x bigint, region string"), path)
    new = spark.createDataFrame([(5, "01"), (6, "gb"), (7, None)], "x bigint, region string")
    with monkeypatch.context() as patched:
        real = sink.write_partitions
        patched.setattr(sink, "write_partitions", lambda df, to, *a, **k: real(df.limit(0), to, *a, **k) if to == path else real(df, to, *a, **k))
        with pytest.raises(Exception, match="."):
            replace_table(new, path)
    assert finish_replacement(spark, path) is True
    assert rows(spark.read.schema(new.schema).parquet(path)) == rows(new)
    assert finish_replacement(spark, path) is False


@pytest.mark.parametrize("managed", [False, True])
def test_switched_table(spark, tmp_path, managed):
    name = f"switched_{'managed' if managed else 'external'}"
    for table in (name, f"{name}__before", f"{name}__coming"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    old = spark.createDataFrame([(1, "us"), (2, "gb")], "x bigint, region string")
    write_table(old, name, path=None if managed else str(tmp_path / "first"))
    with pytest.raises(PySparkException):
        switch_table(failing_rows(spark), name)
    assert rows(spark.table(name)) == rows(old)
    for x in (3, 4):
        path = switch_table(spark.createDataFrame([(x, "us")], old.schema), name)
        assert rows(spark.table(name)) == [(x, "us")] and table_location(spark, name).endswith(Path(path).name)
    assert rows(spark.table(f"{name}__before")) == [(3, "us")]


def test_names_of_others_are_not_taken(spark, tmp_path):
    lake = Lake(str(tmp_path))
    table = spark.createDataFrame([(1, "us")], "x bigint, region string")
    write_partitions(table, lake.path("trending_analytics"))
    spark.sql("CREATE DATABASE IF NOT EXISTS mine")
    spark.sql("DROP TABLE IF EXISTS mine.trending_analytics")
    write_table(spark.createDataFrame([(i, "us") for i in range(5)], table.schema), "mine.trending_analytics")
    with pytest.raises(ValueError, match="table of its own"):
        register_tables(spark, lake, "mine")
    assert spark.table("mine.trending_analytics").count() == 5
    assert register_tables(spark, lake, "ours_now") == ["ours_now.trending_analytics"]
    assert register_tables(spark, lake, "ours_now") == ["ours_now.trending_analytics"]
