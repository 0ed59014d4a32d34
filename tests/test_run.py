from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.files import category, csv_line, put_categories, put_csv, put_document, video
from trendlake.operators import counts
from trendlake.operators.documents import envelope, expected_regions, summary_of_counts
from trendlake.operators.quality import QualityGateError, QualityRules
from trendlake.plans import run
from trendlake.plans.run import Lake, run_lake, silver_frames
from trendlake.sources.categories import read_category_documents
from trendlake.sources.statistics import read_document_sizes


@pytest.fixture
def lake(tmp_path):
    lake = Lake(str(tmp_path))
    raw, reference = Path(lake.raw_statistics), Path(lake.raw_reference)
    put_csv(raw, "us", *(csv_line(f"v{i}", views=str(i * 100), category="1") for i in range(8)))
    put_csv(raw, "gb", csv_line("v1", category="29"), csv_line("v1", category="29"))
    put_document(raw, "us", *(video(f"w{i}", category="34") for i in range(4)))
    put_categories(reference, "US", category("1", "Film"), category("29", "Nonprofits"))
    put_categories(reference, "gb", category("1", "Film"), category("23", "Comedy"), category("34", "Comedy"))
    return lake


def expected_regions_of(report):
    return rows(report.ingest, "region", "videos", "status")


@pytest.mark.parametrize("incremental", [False, True])
def test_whole_run(spark, lake, tmp_path, noon, incremental):
    options = {"checkpoint": str(tmp_path / "progress")} if incremental else {}
    report = run_lake(spark, lake, regions=["us", "gb"], as_of=noon,
                      rules=QualityRules(min_rows=4), **options)
    assert expected_regions_of(report) == [("gb", 0, "failed"), ("us", 4, "success")]
    assert rows(report.files, "region", "rows", "error") == [("US", 2, None), ("gb", 3, None)]
    assert rows(report.outcomes) == [
        ("gb", "failed", "trending", "no document"), ("us", "success", None, None)
    ]
    assert {r[0] for r in rows(report.checks, "passed")} == {True}
    assert report.rows == {
        "trending_analytics": 3, "channel_analytics": 2, "category_analytics": 3
    }
    silver = silver_frames(spark, lake)["clean_statistics"]
    assert silver.count() == 13
    category_rows = rows(
        spark.read.parquet(lake.path("category_analytics")),
        "region", "category_name", "category_id", "video_count", "view_share_pct",
    )
    assert category_rows == [
        ("gb", "Nonprofits", 29, 1, 100.0),
        ("us", "Comedy", 34, 4, 100.0),
        ("us", "Film", 1, 8, 100.0),
    ]
    again = run_lake(spark, lake, regions=["us"], as_of=noon,
                     rules=QualityRules(min_rows=4), **options)
    assert again.rows == report.rows


def test_gate_keeps_reports_from_being_built(spark, lake, noon):
    with pytest.raises(QualityGateError) as raised:
        run_lake(spark, lake, as_of=noon)
    failed = json.loads(raised.value.failed)
    assert {(f["check"], f["table"]) for f in failed} == {("row_count", "clean_reference_data")}
    assert not Path(lake.path("trending_analytics")).exists()


def test_run_lands_new_documents_first(spark, lake, noon):
    docs = read_category_documents(spark, lake.raw_reference).select("region", "kind", "etag", "items")
    extra = docs.filter("region = 'gb'").withColumn("region", F.lit("fr"))
    report = run_lake(
        spark, lake, as_of=noon, rules=QualityRules(min_rows=4),
        category_documents=[envelope(extra, "test", noon, count_items=False)],
    )
    assert ("fr", 3, None) in rows(report.files, "region", "rows", "error")


def test_no_categories_is_an_error(spark, tmp_path):
    lake = Lake(str(tmp_path))
    put_categories(Path(lake.raw_reference), "us")
    with pytest.raises(ValueError, match="no category items"):
        run_lake(spark, lake)


def test_nothing_to_read_stops_at_the_gate(spark, tmp_path, noon):
    lake = Lake(str(tmp_path))
    put_categories(Path(lake.raw_reference), "us", *(category(str(i), "n") for i in range(10)))
    with pytest.raises(QualityGateError, match="clean_statistics not found"):
        run_lake(spark, lake, as_of=noon)


def test_only_some_regions(spark, lake, noon):
    rules = QualityRules(min_rows=1)
    run_lake(spark, lake, only_from=["gb"], as_of=noon, rules=rules)
    silver = silver_frames(spark, lake)["clean_statistics"]
    assert rows(silver.select("region").distinct()) == [("gb",)]


def test_tables_can_be_named_in_sql(spark, lake, noon):
    run_lake(spark, lake, regions=["us", "gb"], as_of=noon, rules=QualityRules(min_rows=4), database="lake_names")
    names = {t.name for t in spark.catalog.listTables("lake_names")}
    assert names >= {"clean_statistics", "clean_reference_data", "category_analytics", "quality_checks", "row_warnings"}
    count = spark.sql("SELECT count(*) FROM lake_names.clean_statistics WHERE region = 'us'").first()[0]
    assert count == 12
    assert spark.sql("SELECT sum(video_count) FROM lake_names.category_analytics").first()[0] == 13
    assert spark.sql("SELECT sum(rows) FROM lake_names.row_warnings").first()[0] == 13


def test_reports_are_stored_when_the_gate_closes(spark, lake, noon):
    with pytest.raises(QualityGateError):
        run_lake(spark, lake, as_of=noon, rules=QualityRules(min_rows=1000))
    checks = spark.read.parquet(lake.path("quality_checks"))
    assert checks.filter("not passed").count() > 0
    assert spark.read.parquet(lake.path("ingest_summary")).count() == 10
    assert not Path(lake.path("category_analytics")).exists()


def test_rebuild_drops_what_raw_files_no_longer_hold(spark, lake, noon):
    import shutil

    options = {"as_of": noon, "rules": QualityRules(min_rows=1)}
    run_lake(spark, lake, **options)
    shutil.rmtree(Path(lake.raw_statistics) / "region=gb")
    run_lake(spark, lake, **options)
    for table in ("clean_statistics", "trending_analytics", "channel_analytics"):
        got = spark.read.option("basePath", lake.path(table)).parquet(lake.path(table))
        assert {r.region for r in got.select("region").distinct().collect()} == {"us"}


def test_incremental_summary_reads_new_files_only_and_counts_those_that_are_there(spark, lake, tmp_path, noon, monkeypatch):
    options = {"regions": ["us", "gb"], "as_of": noon, "rules": QualityRules(min_rows=4), "checkpoint": str(tmp_path / "progress")}
    raw, read = Path(lake.raw_statistics), []

    def seen(session, path, folders, layout, files=None):
        read.append(None if files is None else len(files))
        return read_document_sizes(session, path, folders, layout, files)

    monkeypatch.setattr(run, "read_document_sizes", seen)
    odd = put_document(raw, "gb", video("x1"), name="a [1] é%20{b}")
    assert expected_regions_of(run_lake(spark, lake, **options)) == [("gb", 1, "success"), ("us", 4, "success")]
    assert expected_regions_of(run_lake(spark, lake, **options)) == [("gb", 1, "success"), ("us", 4, "success")]
    put_document(raw, "gb", video("x1"), video("x2"), name="a [1] é%20{b}")
    (odd.parent / "cut.json").write_text('{"items": [', encoding="utf-8")
    assert expected_regions_of(run_lake(spark, lake, **options)) == [("gb", 2, "failed"), ("us", 4, "success")]
    (odd.parent / "cut.json").unlink()
    assert expected_regions_of(run_lake(spark, lake, **options)) == [("gb", 2, "success"), ("us", 4, "success")]
    assert read == [None, 2]


def summary_of(report):
    return rows(report.ingest, "region", "documents", "videos", "unreadable", "status")


SUMMARY = [("de", 0, 0, 0, "failed"), ("gb", 2, 1, 1, "failed"), ("us", 2, 4, 0, "success")]
#: Enough of every table for its checks, even if it holds few rows.
LENIENT = QualityRules(min_rows=0, freshness_hours=10**6, max_null_pct=100.0)


def put_odd_documents(lake):
    raw = Path(lake.raw_statistics)
    put_document(raw, "us", name="no-items")
    cut = put_document(raw, "gb", video("x1"), name="cut")
    cut.write_text(json.dumps(json.loads(cut.read_text())) + "\n{cut", encoding="utf-8")
    put_document(raw, "fr", video("x2"), name="not-expected")


def test_rebuild_counts_documents_while_it_builds(spark, lake, noon, monkeypatch):
    put_odd_documents(lake)
    read = []
    monkeypatch.setattr(run, "read_document_sizes", lambda *args: read.append(args) or read_document_sizes(*args))
    report = run_lake(spark, lake, regions=["us", "gb", "de", "us"], as_of=noon, rules=LENIENT)
    assert sorted(set(summary_of(report))) == SUMMARY
    assert not read
    assert rows(report.counts, "rows_read") == [(8 + 2 + 4 + 1 + 1,)]


@pytest.mark.parametrize("only_from", [["US "], ["gb", "de"]])
def test_rebuild_of_some_regions_counts_all(spark, lake, noon, only_from):
    put_odd_documents(lake)
    seen = counts.DocumentCounts(["us", "gb", "de"], only_from)
    run.refresh_silver(spark, lake, only_from, noon, seen)
    assert seen.values(spark, lake.raw_statistics, lake.landing) is not None
    landed = run.counts_of_rebuild(spark, lake, seen, only_from)
    summary = summary_of_counts(landed, expected_regions(spark, ["us", "gb", "de"]))
    assert rows(summary, "region", "documents", "videos", "unreadable", "status") == SUMMARY


def test_documents_that_may_be_counted_twice_are_read_again(spark, lake, noon, monkeypatch):
    put_odd_documents(lake)
    seen = []
    monkeypatch.setattr(run, "read_document_sizes", lambda *args: seen.append(args) or read_document_sizes(*args))
    twice = counts.DocumentCounts.files
    monkeypatch.setattr(counts.DocumentCounts, "files", lambda self, df: twice(self, df.union(df)))
    report = run_lake(spark, lake, regions=["us", "gb", "de"], as_of=noon, rules=LENIENT)
    assert len(seen) == 1
    assert summary_of(report) == SUMMARY
