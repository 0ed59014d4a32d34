from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendlake.operators.quality import (
    QualityGateError,
    QualityRules,
    check_catalog,
    check_table,
    failed_checks,
    require_quality,
    run_checks,
    verdict,
)

TABLE = "clean_statistics"


def table(spark, n=20, **columns):
    base = {
        "video_id": F.col("id").cast("string"),
        "title": F.lit("t"),
        "channel_title": F.lit("c"),
        "views": F.col("id"),
        "region": F.lit("us"),
    }
    return spark.range(n).select(*(c.alias(k) for k, c in {**base, **columns}.items()))


def check(df, name, *columns, **options):
    results = check_table(df, options.pop("table", TABLE), **options)
    return rows(results.filter(F.col("check") == name), *columns)


def test_everything_passes(spark, noon):
    results = check_table(table(spark, _processed_at=F.lit(noon)), TABLE, as_of=noon)
    assert rows(verdict(results)) == [(True, 9, 9)]
    assert rows(failed_checks(results)) == []
    require_quality(results)


@pytest.mark.parametrize("n, passed", [(9, False), (10, True), (0, False)])
def test_row_count(spark, n, passed):
    assert check(table(spark, n), "row_count", "value", "threshold", "passed", "message") == [
        (float(n), 10.0, passed, f"Row count: {n} (min: 10)")
    ]


def test_null_percentage_is_compared_unrounded(spark):
    def title(bad, n):
        gaps = F.when(F.col("id") >= bad, "t")
        got = check(table(spark, n, title=gaps), "null_pct", "column", "value", "passed", "message")
        return [r[1:] for r in got if r[0] == "title"][0]

    assert title(5, 100) == (5.0, True, "title null%: 5.00% (max: 5.0%)")
    assert title(5_001, 100_000) == (5.0, False, "title null%: 5.00% (max: 5.0%)")
    assert title(0, 100) == (0.0, True, "title null%: 0.00% (max: 5.0%)")


def test_null_percentage_of_nothing_and_of_nan(spark):
    assert {r[0] for r in check(table(spark, 0), "null_pct", "passed")} == {True}
    nan = F.when(F.col("id") < 10, F.lit("NaN").cast("double")).otherwise(1.0)
    got = check(table(spark, 20, views=nan), "null_pct", "column", "value", "passed")
    assert ("views", 50.0, False) in got


def test_missing_column_fails_twice(spark):
    df = table(spark).drop("title")
    assert check(df, "null_pct", "column", "value", "passed", "message")[1] == (
        "region", 0.0, True, "region null%: 0.00% (max: 5.0%)"
    )
    assert ("title", None, False, "Column 'title' missing from table") in check(
        df, "null_pct", "column", "value", "passed", "message"
    )
    assert check(df, "schema", "missing_columns", "passed", "message") == [
        (["title"], False, "Missing columns: title")
    ]
    assert check(table(spark), "schema", "missing_columns", "passed") == [([], True)]


@pytest.mark.parametrize(
    "value, negative, extreme",
    [(-1, 1, 0), (50_000_000_000, 0, 0), (50_000_000_001, 0, 1), (None, 0, 0)],
)
def test_value_range(spark, value, negative, extreme):
    views = F.when(F.col("id") == 3, F.lit(value).cast("bigint")).otherwise(F.col("id"))
    got = check(table(spark, views=views), "value_range", "negative_count", "extreme_count", "passed")
    assert got == [(negative, extreme, negative + extreme == 0)]


def test_value_range_is_for_statistics_with_views_only(spark):
    assert check(table(spark), "value_range", "passed", table="clean_reference_data") == []
    assert check(table(spark).drop("views"), "value_range", "passed") == []


@pytest.mark.parametrize("hours, passed", [(48, True), (49, False)])
def test_freshness(spark, noon, hours, passed):
    at = F.lit(noon - timedelta(hours=hours))
    old = F.lit(noon - timedelta(days=99))
    df = table(spark, _ingestion_timestamp=old, _processed_at=at)
    assert check(df, "freshness", "passed", as_of=noon) == [(passed,)]


def test_freshness_special_cases(spark, noon):
    def one(column):
        return check(table(spark, _ingestion_timestamp=column), "freshness", "passed", "message", as_of=noon)[0]

    assert check(table(spark), "freshness", "passed") == [(True,)]
    assert one(F.lit(None).cast("timestamp"))[0] is False
    assert one(F.lit("2024-03-01T11:00:00+00:00")) == (
        True, "Latest: 2024-03-01 11:00:00+00:00, Cutoff: 2024-02-28 12:00:00+00:00"
    )
    assert one(F.lit("2024-03-01T11:00:00.5+00:00"))[1].startswith("Latest: 2024-03-01 11:00:00.500000+00:00,")
    unreadable = F.when(F.col("id") == 1, "garbage").otherwise("2001-01-01")
    assert one(unreadable) == (True, "Could not parse timestamps: 1 values — skipping")


def test_rules_and_sample(spark):
    rules = QualityRules(min_rows=2, critical={TABLE: ("video_id",)})
    assert check(table(spark, 2), "row_count", "passed", rules=rules) == [(True,)]
    assert len(check(table(spark), "null_pct", "column", rules=rules)) == 1
    assert check(table(spark), "row_count", "value", sample_rows=12) == [(12.0,)]


def test_suite_goes_on_after_an_unreadable_table(spark, tmp_path, noon):
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet at all")
    frames = {
        "broken": spark.read.schema("id string").parquet(str(broken)),
        "gone": None,
        TABLE: table(spark, _processed_at=F.lit(noon)),
    }
    results = run_checks(spark, frames, as_of=noon)
    assert rows(results.filter("check = 'read_table'"), "table", "passed") == [
        ("broken", False), ("gone", False)
    ]
    assert rows(verdict(results)) == [(False, 9, 11)]
    with pytest.raises(QualityGateError, match="gone"):
        require_quality(results)


def test_check_catalog_by_name(spark, tmp_path):
    table(spark).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("clean_reference_data")
    results = check_catalog(spark, ["clean_reference_data", "not_there"], database="default")
    assert rows(results, "table", "check", "passed") == [
        ("clean_reference_data", "freshness", True),
        ("clean_reference_data", "null_pct", False),
        ("clean_reference_data", "null_pct", True),
        ("clean_reference_data", "row_count", True),
        ("clean_reference_data", "schema", False),
        ("not_there", "read_table", False),
    ]
