"""Ranks and shares within groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.schemas import SHARE_DIGITS
from trendlake.shared import materialize

# Fixed value: monotonically_increasing_id holds the partition above this bit.
PARTITION_BIT = 33


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """Row number within each group, for groups of any size.

    A window over the group would sort a whole group in one task. Here the rows are sorted
    over all partitions by (group, order), which splits a large group; a row's number is its
    distance from the start of its group within its partition, plus the group's rows in the
    partitions before. The sorted rows are stored once, because both steps must see the same
    partitions. ``order`` has to be total.
    """
    by_group = [F.col(name).asc_nulls_first() for name in group]
    placed = materialize(
        df.orderBy(*by_group, *order).withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    )
    part = F.shiftright("_at", PARTITION_BIT)
    pieces = placed.groupBy(*group, part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = pieces.select(
        *(F.col(g).alias(f"_{g}") for g in group),
        F.col("_part").alias("_start_part"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same = part == F.col("_start_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return placed.join(starts, same).select(
        *df.columns, (F.col("_at") + F.col("_shift")).alias(name)
    )


def share_of_group(df: DataFrame, value: str, group: Sequence[str], name: str) -> DataFrame:
    """``value`` in percent of its group's total; NULL for a total of 0. NULL is a group like any other.

    For groups of any size: totals are summed within tasks first and joined back, one row per group. Spark broadcasts them
    while they are below ``spark.sql.autoBroadcastJoinThreshold``, and splits a large group's side of a shuffled join
    otherwise. ``df`` is evaluated for the totals and for the rows: give it stored or aggregated.
    """
    keys = {g: f"_group_{i}" for i, g in enumerate(group)}
    totals = df.groupBy(*(F.col(g).alias(key) for g, key in keys.items())).agg(F.sum(value).alias("_total"))
    same = reduce(Column.__and__, (F.col(g).eqNullSafe(F.col(key)) for g, key in keys.items()), F.lit(True))
    share = F.round(F.try_divide(F.col(value), F.col("_total")) * 100, SHARE_DIGITS)
    return df.join(totals, same).select(*df.columns, share.alias(name))
