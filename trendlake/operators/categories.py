"""Category names: the lookup and joining it."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.functions.columns import find, pick
from trendlake.schemas import UNKNOWN_CATEGORY


def category_lookup(reference: DataFrame | None) -> DataFrame | None:
    """One name per category id, over all regions: some ids are listed in one region only.

    None, with a warning, if there is no reference data or it lacks id or title.
    """
    if reference is None:
        return None
    if not (find(reference.schema, "id") and find(reference.schema, "snippet.title")):
        warnings.warn(f"no category id and title in {reference.columns}", stacklevel=2)
        return None
    named = reference.select(
        pick(reference, "id", "bigint").alias("category_id"),
        pick(reference, "snippet.title", "string").alias("category_name"),
    )
    return unique_names(named.dropna(subset=["category_id"]))


def unique_names(named: DataFrame) -> DataFrame:
    """One name per id, always the same one if an id has several."""
    return named.groupBy("category_id").agg(F.min("category_name").alias("category_name"))


def enrich_category(df: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Add category_name to rows of any grain; ids without a name become Unknown.

    No broadcast hint: Spark broadcasts the lookup while its size is below
    ``spark.sql.autoBroadcastJoinThreshold``, by file statistics or measured at run time,
    and otherwise joins by shuffle, splitting ids that hold too many rows.
    """
    if lookup is None:
        if "category_name" not in df.columns:
            return df.withColumn("category_name", F.lit(UNKNOWN_CATEGORY))
        return df.fillna(UNKNOWN_CATEGORY, subset=["category_name"])
    bare = df.drop("category_name")
    columns = [*bare.columns, "category_name"]
    typed = bare.withColumn("category_id", pick(bare, "category_id", "bigint"))
    joined = typed.join(lookup, "category_id", "left").select(*columns)
    return joined.fillna(UNKNOWN_CATEGORY, subset=["category_name"])
