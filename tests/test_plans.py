"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, rows
from trendlake import registry
from trendlake.operators.quality import check_table
from trendlake.plans import gold, reports
from trendlake.sinks.tables import write_partitions
from trendlake.sources.tables import only_regions


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    write_partitions(registry.silver(spark, SF_DIR), path)
    return spark.read.parquet(path)


def scans(text):
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", text.split("== Physical Plan ==")[-1])


def test_gold_reads_only_its_columns(stored, plan):
    for df in (gold.trending_analytics(stored), gold.unranked_channels(stored)):
        for schema in scans(plan(df)):
            assert "description" not in schema and "title:string,title" not in schema
            assert not re.search(r"[<,](tags|title|thumbnail_link|publish_time):", schema)


def test_regional_table_needs_no_row_multiplication(stored, plan):
    """Two distinct counts over raw rows would multiply them; here they don't."""
    text = plan(gold.trending_analytics(stored)).split("== Physical Plan ==")[-1]
    assert "Expand" not in text


def test_region_filter_prunes_folders(stored, plan):
    text = plan(only_regions(stored, ["asia"]))
    assert re.search(r"PartitionFilters: \[[^\]]*region", text)
    kept = only_regions(stored, ["asia"]).inputFiles()
    assert len(kept) >= 1


def test_filters_reach_the_scan(stored, plan):
    text = plan(stored.filter("views > 10").select("video_id"))
    assert "GreaterThan(views,10)" in text


def test_top_lists_are_not_full_sorts(stored, plan):
    category = gold.category_analytics(stored)
    assert "TakeOrderedAndProject" in plan(reports.top_category_days(category))


def test_checks_are_one_pass(stored, plan):
    text = plan(check_table(stored.withColumn("_processed_at", F.current_timestamp()), "clean_statistics"))
    physical = text.split("== Physical Plan ==")[-1]
    assert physical.count("FileScan") == 1 and physical.count("Exchange") == 1


@pytest.mark.parametrize("name", ["silver_statistics", "category_analytics_facts"])
def test_generated_code_is_small_enough_to_be_compiled(spark, name):
    """The JVM runs methods of more than 8000 bytes without compiling them."""
    df = registry.QUERIES[name](spark, SF_DIR)
    key = "spark.sql.adaptive.enabled"
    try:
        spark.conf.set(key, "false")
        stages = df.select("*")._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length())]
    finally:
        spark.conf.set(key, "true")
    assert 0 < max(sizes) < 8000


@pytest.mark.parametrize("name", ["silver_statistics", "category_analytics_facts", "dq_results"])
def test_no_python_in_the_plan(spark, plan, name):
    physical = plan(registry.QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", physical)


def test_hot_region_and_channel_give_the_same_result(spark):
    """A third of all rows in one group, and partitions of very different size."""
    facts = registry.facts(spark, SF_DIR)
    hot = facts.withColumns(
        {
            "region": F.when(F.col("views") % 3 == 0, "hot").otherwise(F.col("region")),
            "channel_title": F.when(F.col("views") % 3 == 0, "hot").otherwise(F.col("channel_title")),
        }
    )
    whole = rows(gold.trending_analytics(hot).drop("_aggregated_at"))
    split = rows(gold.trending_analytics(hot.repartition(13)).drop("_aggregated_at"))
    assert whole == split
    channels = rows(gold.channel_analytics(hot).drop("_aggregated_at"))
    assert channels == rows(gold.channel_analytics(hot.repartition(11, "region")).drop("_aggregated_at"))
