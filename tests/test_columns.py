from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trendlake.functions.columns import flatten, missing_columns, pick, require_columns


@pytest.mark.parametrize("name", ["a.b.c", "a__b__c", "a_b_c"])
def test_pick_finds_every_spelling(spark, name):
    df = spark.createDataFrame([("7",)], f"`{name}` string")
    assert rows(df.select(pick(df, "a.b.c", "bigint"))) == [(7,)]


def test_pick_walks_structs_and_defaults(spark):
    df = spark.range(1).select(F.struct(F.struct(F.lit("7").alias("c")).alias("b")).alias("a"))
    got = df.select(
        pick(df, "a.b.c", "bigint"), pick(df, "a.x", "bigint", 0), pick(df, "y", "string")
    )
    assert rows(got) == [(7, 0, None)]


def test_pick_joins_lists(spark):
    df = spark.createDataFrame([(["a", "b"],)], "tags array<string>")
    assert rows(df.select(pick(df, "tags", "string"))) == [("a|b",)]


def test_flatten(spark):
    df = spark.range(1).select(
        "id", F.struct(F.lit(1).alias("x"), F.struct(F.lit(2).alias("z")).alias("y")).alias("s")
    )
    assert flatten(df).columns == ["id", "s_x", "s_y_z"]
    assert rows(flatten(df)) == [(0, 1, 2)]


def test_required_columns(spark):
    schema = spark.createDataFrame([], "id string, snippet struct<title: string>").schema
    assert missing_columns(schema, ["id", "snippet.title"]) == []
    assert missing_columns(schema, ["b", "a", "id"]) == ["a", "b"]
    with pytest.raises(ValueError, match="missing"):
        require_columns(schema, ["a"])
    with pytest.warns(UserWarning, match="missing"):
        assert require_columns(schema, ["a"], on_missing="warn") == ["a"]
