"""Mixing sources to target weights by exact budgets.

Every document gets a hash-random key, and the keys of a source are cut into ranges. A source's
budget is met by whole repeats of all its documents and a last, partial one: sums per range and their
prefix sums give the range in which the budget ends, and the prefix sums within that range the one
document. Only rows of these ranges are ordered one by one; the cuts, a row per source, are then
compared with every document's key, so that texts are never moved.

Defined cases: a null or empty text has size 0 and is never taken. A null source is a source, the
last in order. Rows that agree in doc_id and text share one key; if a budget ends among them, each gets an equal
part, rounded down. With no words at all every target is 0. Extra columns are passed on; the result's
names are the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import own_name, text_or_empty
from trendlake.shared import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Ranges of a source's keys: so many hex digits.
RANGE_DIGITS = 3
#: Files of the stored sums, 4096 rows per source in all.
RANGE_FILES = 8
BLANKS_AND_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def random_key(doc_id: str, text: str) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.md5(text_or_empty(text))))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target from a row per source.

    Sources in order of code points, null last, weigh ``weights`` in turn and share the sum of all sizes;
    a target ends at ``repeats`` times its source, and others share the excess. So a target is
    ``least(cap, weight * rate)`` with one rate: sources are capped in order of cap / weight until the rest
    stays below theirs. These windows hold a row per source.
    """
    position = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(position) - 1, F.lit(len(weights)))
    weighed = totals.select(
        "source",
        "source_size",
        F.get(F.array(*map(F.lit, weights)), turn).cast("long").alias("weight"),
        (F.col("source_size") * repeats).alias("cap"),
    )
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy(F.lit(0))
    before, after = (Window.unboundedPreceding, -1), (0, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(*before)), F.lit(0))
    rated = weighed.withColumn(
        "rate", left.cast("double") / F.sum("weight").over(by_ratio.rowsBetween(*after)).cast("double")
    )
    # Capping one source more than needed lowers the rate, so the highest rate that fits is the right one.
    fits = F.when(F.col("rate") * F.col("weight") <= F.col("cap"), F.col("rate"))
    return (
        rated.withColumn("final", F.max(fits).over(all_rows))
        .select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("final")).alias("target"))
    )


def mix(
    docs: DataFrame,
    size: Column,
    names: tuple[str, str, str, str] = ("size", "source_size", "target", "taken"),
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``docs`` with size, source_size, target and taken: the words a mix takes of each document."""
    light = docs.select(F.col(source).alias("source"), size.alias("size"), random_key(doc_id, text).alias("key"))
    light = light.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    light = materialize(light, "mix-sizes")
    ranges = light.groupBy("source", "range").agg(F.sum("size").alias("size"))
    ranges = materialize(ranges.repartition(RANGE_FILES, "source", "range"), "mix-ranges")
    shares = targets(ranges.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    budget = F.round("target").cast("long")
    shares = shares.withColumns(
        {
            "whole": F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)),
        }
    )
    shares = shares.withColumn("part", F.when(F.col("source_size") > 0, budget - F.col("whole") * F.col("source_size")).otherwise(F.lit(0)))
    shares = materialize(shares.repartition(1), "mix-shares")  # a row per source

    # The range in which the part ends, then the key.
    one_source = Window.partitionBy("source")
    before = F.sum("size").over(one_source.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    ends = shares.select(F.col("source").alias("of"), "part")
    cut_ranges = (
        ranges.withColumn("before", before)
        .join(ends, F.col("source").eqNullSafe(F.col("of")))
        .where((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("size")))
        .select("of", F.col("range").alias("cut_range"), F.col("before").alias("before_range"), "part")
    )
    rows = light.join(
        cut_ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("cut_range"))
    )
    keys = rows.groupBy("source", "key", "before_range", "part").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")
    )
    key_before = F.sum("size").over(one_source.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    cuts = (
        keys.withColumn("before", key_before + F.col("before_range"))
        .where((F.col("before") <= F.col("part")) & (F.col("part") < F.col("before") + F.col("size")))
        .select(
            F.col("source").alias("of"),
            F.col("key").alias("cut_key"),
            F.floor((F.col("part") - F.col("before")) / F.col("rows")).alias("last"),
        )
    )
    plan = shares.join(cuts, shares["source"].eqNullSafe(cuts["of"]), "left").drop("of")
    own = {c: own_name(c) for c in ("source", "source_size", "target", "whole", "cut_key", "last", "size", "key")}
    plan = plan.select(*(F.col(c).alias(own[c]) for c in own if c not in ("size", "key")))
    plan = materialize(plan.repartition(1), "mix-plan")
    keyed = docs.withColumns({own["size"]: size, own["key"]: random_key(doc_id, text)})
    joined = keyed.join(plan, keyed[source].eqNullSafe(plan[own["source"]]), "left")
    o = {c: F.col(own[c]) for c in own}
    part = (
        F.when(o["key"] < o["cut_key"], o["size"])
        .when(o["key"] == o["cut_key"], F.least(o["last"], o["size"]))
        .otherwise(F.lit(0))
    )
    taken = (o["whole"] * o["size"] + part).cast("long")
    return joined.select(
        *(F.col(c) for c in docs.columns if c not in names),
        o["size"].cast("long").alias(names[0]),
        o["source_size"].cast("long").alias(names[1]),
        o["target"].alias(names[2]),
        taken.alias(names[3]),
    )


def mixed_rows(docs: DataFrame, size: Column, text: str = "text", **options) -> DataFrame:
    """The mix itself: each document's row as often as it is taken whole, and once more up to its last word taken."""
    names = tuple(own_name(n) for n in ("size", "source_size", "target", "taken"))
    turn = own_name("turn")
    chosen = mix(docs, size, names, text=text, **options)
    of, taken = F.col(names[0]), F.col(names[3])
    turns = chosen.where(taken > 0).withColumn(turn, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((taken - 1) / of))))
    left = F.least(of, taken - F.col(turn) * of)
    words = F.regexp_extract_all(F.col(text), F.lit(BLANKS_AND_WORD), F.lit(0))
    cut = F.when(left < of, F.array_join(F.slice(words, F.lit(1), left.cast("int")), "")).otherwise(F.col(text))
    return turns.withColumn(text, cut).select(*docs.columns)
