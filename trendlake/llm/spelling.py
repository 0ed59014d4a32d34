"""Groups of spelling variants, found by sorting the rotations of all words (a permuterm index).

A rotation of the terminator-marked word ``a x b $`` that starts behind the edited character x is ``b $ a x``: x comes last. So
all words that differ in x alone, and the word without x, have rotations with the prefix ``b $ a``, the latter as a whole. The rotations
are sorted over all partitions by that prefix, and a scan of the sorted rows takes each prefix as one group. All members of a group
are near one another, so a member's neighbours there are known from the group's size and its two most frequent words, and no
pairs are written. A group has a word per character at most, and one more: no word is hot, however frequent.

A pair that differs by a replacement meets at one prefix. A pair that differs by a deletion within equal characters (``aab``, ``ab``)
meets at several; only the first of the equal characters counts it.

Defined cases: null words take no part. Rows of one word are added up. A word may be empty, of any length, and hold any character, the
terminator too, as prefixes are told apart by its place. Equal counts go to the smaller word in code-point order. An empty table gives an
empty result. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.llm.common import text_or_empty
from trendlake.shared import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[A-Za-zÀ-ÿ]+"
END = "$"


def runs_of(text: str | Column) -> Column:
    """The runs of letters of a text, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text_or_empty(text), UPPER, LOWER), F.lit(RUN), F.lit(0))


def count_words(words: DataFrame, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """word, n of a table with a ``word`` per row: those of enough code points and occurrences."""
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """word, n, stem, at, edited, counts: a row per rotation of every word, and per rotation without its last character.

    ``stem`` is the rotation without ``edited`` (null: nothing was left out) and ``at`` the terminator's place in it. ``counts`` tells
    whether the shorter word is counted as a neighbour here.
    """
    word, length = F.col("word"), F.length("word")

    def rotation(begin: Column, end: Column, edited: Column, counts: Column) -> Column:
        rest = F.substr(word, begin)
        stem = F.concat(rest, F.lit(END), F.substr(word, F.lit(1), end))
        return F.struct(stem.alias("stem"), F.length(rest).alias("at"), edited.alias("edited"), counts.alias("counts"))

    def without(i: Column) -> Column:
        own = F.substr(word, i, F.lit(1))
        first = (i == 1) | (F.substr(word, i - 1, F.lit(1)) != own)
        return rotation(i + 1, i - 1, own, first)

    whole = F.transform(F.sequence(F.lit(0), length), lambda i: rotation(i + 1, i, F.lit(None).cast("string"), F.lit(False)))
    places = F.when(length > 0, F.sequence(F.lit(1), length)).otherwise(F.lit([]).cast("array<int>"))
    every = F.explode(F.concat(whole, F.transform(places, without))).alias("r")
    return words.select("word", "n", every).select("word", "n", "r.*")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, near, near_n: the number of words one edit away and the most frequent of them, for words that have any."""
    ordered = rotations(words).repartitionByRange("stem").sortWithinPartitions("stem", "at", F.desc("n"), "word")
    # The window takes over order and partitions of the sorted rotations: a scan of each group.
    group = Window.partitionBy("stem", "at").orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    member = F.struct((-F.col("n")).alias("rank"), "word")
    scanned = ordered.select(
        "word",
        "edited",
        "counts",
        F.count(F.lit(1)).over(group).alias("members"),
        F.count("edited").over(group).alias("longer"),
        F.count(F.when(F.col("counts"), 1)).over(group).alias("counted"),
        F.first(member).over(group).alias("best"),
        F.nth_value(member, 2).over(group).alias("next"),
    ).where(F.col("members") > 1)
    shorter = (F.col("counts") & (F.col("members") > F.col("longer"))).cast("long")
    near = F.when(F.col("edited").isNull(), F.col("counted")).otherwise(F.col("longer") - 1 + shorter)
    other = F.when(F.col("best")["word"] == F.col("word"), F.col("next")).otherwise(F.col("best"))
    best = scanned.select("word", near.alias("near"), other.alias("other")).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min("other").alias("best")
    )
    return best.select("word", "n_near", F.col("best")["word"].alias("near"), (-F.col("best")["rank"]).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that the forms (word, form) lead to.

    Every round doubles the steps taken. A form is more frequent than its word by a factor, so ways have a few steps.
    """
    current = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("later"))
        stepped = current.join(onward, "root", "left").select("word", F.coalesce("later", "root").alias("root"), F.col("later").isNotNull().alias("moved"))
        current = materialize(stepped, "spelling-roots")
        if current.where("moved").isEmpty():
            return current.select("word", "root")
        current = current.select("word", "root")


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of words and their counts.

    The form is the most frequent neighbour if it is at least ``ratio`` times as frequent, the root the last of the forms' chain.
    """
    if ratio <= 1:
        raise ValueError("with a ratio of one or less, forms could go round in circles")
    words = materialize(words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    enough = F.col("near_n") >= ratio * F.col("n")
    found = words.join(neighbours(words), "word", "left").select(
        "word",
        F.when(enough, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("near_n")).alias("form_n"),
    )
    found = materialize(found, "spelling-forms")
    chains = roots(found.where(F.col("form").isNotNull()))
    return found.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
