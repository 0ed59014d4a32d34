"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """Per key the row with the greatest ``newest_first`` values.

    All other columns break ties, so the same rows give the same result in any order of
    arrival. Spark keeps one row per key and task before it shuffles (WindowGroupLimit), so
    a key that holds a large share of all rows sends one row per task, not all of them.
    """
    rest = [name for name in df.columns if name not in (*keys, *newest_first)]
    order = [F.col(name).desc_nulls_last() for name in newest_first]
    order += [F.col(name).asc_nulls_first() for name in rest]
    return first_per_key(df, keys, order)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select("*", place.alias("_place")).where("_place = 1").drop("_place")


def keep_last(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Per key the row that came last by position."""
    return latest_per_key(df, keys, [position]).drop(position)


def removed_by_dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows read, rows kept and rows removed by keeping one per key.

    Grouping first keeps it exact and lets Spark combine before the shuffle.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    read, kept = F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))
    return per_key.agg(
        read.alias("rows_read"), kept.alias("rows_kept"), (read - kept).alias("rows_removed")
    )
