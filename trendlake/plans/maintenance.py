"""Report tables kept up to date from the days that new rows touched.

Every merged batch of statistics records the regions and days it touched (``record_touched``). :func:`maintain_gold` takes the
records that no earlier call has taken, and

* builds the base, a row per region, day, category and channel, and from it the two day tables anew for those days, reading
  these partitions of silver only,
* finds the channels of those days, before and after, adds up their rows of the stored base, which merges as it holds sums, and counts
  their videos from three columns of silver. Other channels of the regions are taken as they are stored; ranks are given anew per
  touched region.

Nothing is added to or taken from stored figures, so that a call that was cut short can be made again: the stored base is replaced
after the report tables, and the record of what was done is written last. Without such a record, or if category names have changed,
all tables are built anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.plans import gold
from trendlake.plans.gold import DAY
from trendlake.shared import materialize
from trendlake.sinks.tables import replace_table, write_partitions
from trendlake.streaming.upsert import only_partitions, read_if_there

BASE = "channel_category_days"
STATE = "gold_state"
TOUCHED = T.StructType().add("region", T.StringType()).add("trending_date_parsed", T.DateType()).add("batch", T.LongType())
# What has been built from: the last batch per record, a digest of the names, and that all tables are there.
STATE_SCHEMA = T.StructType().add("source", T.StringType()).add("value", T.LongType())
COMPLETE, NAMES = "complete", "names"

Paths = Callable[[str], str]


def record_touched(days: DataFrame, checkpoint: str, batch_id: int) -> None:
    """Keep the partitions that a batch has changed. A retried batch writes its record again."""
    days.select(*DAY).distinct().write.mode("overwrite").parquet(f"{checkpoint}/touched/batch={batch_id}")


def touched_since(
    spark: SparkSession, checkpoints: Sequence[str], done: dict[str, int]
) -> tuple[DataFrame | None, dict[str, int]]:
    """Region-days recorded after the batches in ``done``, or None, and the last batch of each checkpoint."""
    frames, until = [], {}
    for checkpoint in checkpoints:
        found = read_if_there(spark, f"{checkpoint}/touched", TOUCHED)
        if found is None:
            continue
        new = found.where(F.col("batch") > done.get(checkpoint, -1))
        last = new.agg(F.max("batch")).first()[0]
        if last is not None:
            until[checkpoint] = last
            frames.append(new.where(F.col("batch") <= last).select(*DAY))
    if not frames:
        return None, until
    return materialize(reduce(DataFrame.union, frames).distinct(), "touched-days"), until


def names_digest(lookup: DataFrame | None) -> int:
    if lookup is None:
        return -1
    return lookup.agg(F.coalesce(F.bit_xor(F.xxhash64("category_id", "category_name")), F.lit(0))).first()[0]


def read_state(spark: SparkSession, paths: Paths) -> dict[str, int]:
    found = read_if_there(spark, paths(STATE), STATE_SCHEMA)
    return {} if found is None else {row.source: row.value for row in found.collect()}


def write_state(spark: SparkSession, paths: Paths, state: dict[str, int]) -> None:
    rows = spark.createDataFrame(sorted(state.items()), STATE_SCHEMA)
    rows.coalesce(1).write.mode("overwrite").parquet(paths(STATE))


def rebuild_gold(
    spark: SparkSession,
    paths: Paths,
    stats: DataFrame,
    lookup: DataFrame | None,
    as_of: datetime | None = None,
    done: dict[str, int] | None = None,
) -> None:
    """Build the base and all report tables from all statistics. ``done`` are the batches these hold."""
    write_state(spark, paths, {})
    base = gold.channel_category_days(stats)
    replace_table(base, paths(BASE), DAY)
    base = spark.read.schema(base.schema).parquet(paths(BASE))
    for name, df in gold.gold_of(base, gold.channel_videos(stats), lookup, as_of).tables().items():
        replace_table(df, paths(name))
    write_state(spark, paths, {**(done or {}), NAMES: names_digest(lookup), COMPLETE: 1})


def maintain_gold(
    spark: SparkSession,
    paths: Paths,
    stats: DataFrame,
    lookup: DataFrame | None,
    checkpoints: Sequence[str],
    as_of: datetime | None = None,
) -> bool:
    """Bring the report tables up to date with the batches of ``checkpoints``; whether only touched days were built."""
    state = read_state(spark, paths)
    days, until = touched_since(spark, checkpoints, state)
    if COMPLETE not in state or state.get(NAMES) != names_digest(lookup):
        rebuild_gold(spark, paths, stats, lookup, as_of, {**state, **until})
        return False
    if days is not None:
        _rebuild_days(spark, paths, stats, lookup, days, as_of)
        write_state(spark, paths, {**state, **until})
    return True


def matching(df: DataFrame, keys: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join in which NULL is a key like any other."""
    renamed = keys.select(*columns).toDF(*(f"_{name}" for name in columns))
    same = reduce(lambda a, b: a & b, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in columns))
    return df.join(renamed, same, how)


def touched_base(stats: DataFrame, days: DataFrame) -> DataFrame:
    """The base of the touched days; folders of silver outside of their range aren't read."""
    return gold.channel_category_days(only_partitions(stats, days, DAY))


def _rebuild_days(
    spark: SparkSession,
    paths: Paths,
    stats: DataFrame,
    lookup: DataFrame | None,
    days: DataFrame,
    as_of: datetime | None,
) -> None:
    regions = materialize(days.select("region").distinct(), "touched-regions")

    def stored(name: str, schema: T.StructType) -> DataFrame:
        """Rows of the touched regions."""
        return only_partitions(spark.read.schema(schema).parquet(paths(name)), regions, ("region",))

    new = materialize(touched_base(stats, days), "touched-base")
    before = stored(BASE, new.schema)
    channel = ("channel_title", "region")
    channels = new.select(*channel).union(matching(before, days, DAY, "left_semi").select(*channel))
    channels = materialize(channels.distinct(), "touched-channels")

    merged = matching(matching(before, days, DAY, "left_anti").unionByName(new), channels, channel, "left_semi")
    of_regions = only_partitions(stats.select(*channel, "video_id"), regions, ("region",))
    videos = gold.channel_videos(matching(of_regions, channels, channel, "left_semi"))
    counted = gold.channels_of(merged, videos, lookup)

    trending, category = gold.day_tables(new, lookup)
    results = {}
    for name, rows in (("trending_analytics", trending), ("category_analytics", category)):
        fresh = gold.stamped(rows, as_of)
        kept = matching(stored(name, fresh.schema), days, DAY, "left_anti")
        results[name] = kept.unionByName(fresh)
    others = matching(stored("channel_analytics", counted.schema), channels, channel, "left_anti")
    results["channel_analytics"] = gold.stamped(gold.ranked(others.unionByName(counted)), as_of)

    # All of them before the first is replaced, as they are read from what they replace.
    staged = {name: materialize(df, f"new-{name}") for name, df in results.items()}
    for name, df in staged.items():
        write_partitions(df, paths(name))
    write_partitions(new, paths(BASE), DAY)


def statistics_checkpoints(checkpoint: str) -> list[str]:
    """Where the streams of :func:`~trendlake.streaming.incremental.load_new_statistics` keep their records."""
    return [f"{checkpoint}/{kind}" for kind in schemas.RAW_KINDS]
