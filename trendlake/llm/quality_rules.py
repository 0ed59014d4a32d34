"""Quality rules with cutoffs whose false rejections are bounded by labelled holdouts.

Each rule compares one statistic of a text with a ladder of cutoffs, from lenient to strict. The
level of a document is the number of ladder steps that reject it, over its worst rule; a stratum that
uses level t rejects documents of a level above ``len(ladder) - t``. Ladders are fixed in advance, so all
labelled rows are a holdout: per stratum, the rejections among good documents at each level give an
exact binomial bound (P(X <= k) under the allowed rate). Levels are tested in fixed order, lenient first,
and testing ends at the first failure; over the strata the error is split evenly (Bonferroni). With
probability ``1 - error`` no stratum rejects more than ``false_rejection`` of its good documents.

Defined cases: a null or empty text has no words and fails the base rule. A null stratum is a stratum.
Without enough labels no level is certain, and only the base rule rejects. Repeated rows are judged
alike and all kept or all rejected. Several labels of a document count as the lowest; labels of
unknown documents and null labels count nothing. Extra columns are passed on; added columns have names of the caller's choice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import WORD, let, one_label, own_name, text_or_empty

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
STEPS = 12


@dataclass(frozen=True)
class Rule:
    """``amount / base`` of a text against cutoffs ``lenient * shrink ** step``."""

    name: str
    amount: str
    base: str
    lenient: float
    shrink: float

    def cutoffs(self) -> list[float]:
        return [self.lenient * self.shrink**step for step in range(STEPS)]


RULES = (
    Rule("symbols", "n_symbols", "n_words", 2.0, 0.7),
    Rule("exclamations", "n_exclamations", "n_words", 1.0, 0.7),
    Rule("capitals", "n_capitals", "word_chars", 0.9, 0.85),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.9, 0.85),
    Rule("doubled_words", "n_doubled_words", "n_words", 0.6, 0.85),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.3, 0.9),
)


def repeated_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in ``words``.

    Windows are compared by 64-bit hashes within one text. Most texts repeat none, which a set
    tells; only the others sort their windows.
    """

    def window_key(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, WINDOW))),
        )

    def covered(keys: Column) -> Column:
        pairs = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def again(sorted_pairs: Column) -> Column:
            hit = F.filter(
                sorted_pairs,
                lambda p, j: F.coalesce(p["k"] == F.get(sorted_pairs, j - 1)["k"], F.lit(False))
                | F.coalesce(p["k"] == F.get(sorted_pairs, j + 1)["k"], F.lit(False)),
            )
            return F.sort_array(F.transform(hit, lambda p: p["i"]))

        def spread(positions: Column) -> Column:
            gaps = F.transform(
                positions, lambda p, j: F.least(F.coalesce(F.get(positions, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
            )
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)

        return let(let(pairs, again), spread)

    def of_keys(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), covered(keys)).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(let(hashes, window_key), of_keys)).otherwise(F.lit(0).cast("long"))


def statistics(text: str | Column) -> Column:
    """All statistics of a text as a struct of longs."""
    plain = text_or_empty(text)

    def count(pattern: str) -> Column:
        return F.regexp_count(plain, F.lit(pattern)).cast("long")

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False))))
            .cast("long")
            .alias("n_doubled_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(plain, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    by_word, by_line = own_name("w"), own_name("l")
    parts = F.struct(
        let(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)), of_words).alias(by_word),
        let(lines, of_lines).alias(by_line),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count("!").alias("n_exclamations"),
        count(r"\p{Lu}").alias("n_capitals"),
    )

    def flat(s: Column) -> Column:
        return F.struct(
            *(s[by_word][c].alias(c) for c in ("n_words", "word_chars")),
            s["n_symbols"].alias("n_symbols"),
            s[by_line]["n_dup_lines"].alias("n_dup_lines"),
            s[by_word]["n_repeat_words"].alias("n_repeat_words"),
            s[by_line]["n_lines"].alias("n_lines"),
            s["n_exclamations"].alias("n_exclamations"),
            s["n_capitals"].alias("n_capitals"),
            s[by_word]["n_doubled_words"].alias("n_doubled_words"),
        )

    return let(parts, flat)


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


def level(stats: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Ladder steps that reject a text, over its worst rule: 0 passes the strictest one."""

    def steps(rule: Rule) -> Column:
        value = stats[rule.amount].cast("double")
        hits = [F.when(value > F.lit(c) * stats[rule.base], 1).otherwise(0) for c in rule.cutoffs()]
        return sum(hits[1:], hits[0])

    return F.greatest(*(steps(rule) for rule in rules))


def log_binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """ln P(X <= k) for X ~ Binomial(n, rate), summed term by term in logs."""
    none = n * F.log(F.lit(1 - rate))
    start = F.struct(none.alias("term"), none.alias("total"))
    odds = F.log(F.lit(rate / (1 - rate)))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1).cast("double") / i.cast("double")) + odds
        high, low = F.greatest(term, state["total"]), F.least(term, state["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    index = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(index, start, add, lambda s: s["total"])


def certified_levels(
    judged: DataFrame,
    stratum: str,
    level_column: str,
    good: str,
    false_rejection: float = 0.02,
    error: float = 0.05,
) -> DataFrame:
    """stratum, max_level: what each stratum of labelled rows may keep at most, by exact bounds.

    ``judged`` has a row per labelled document. The tables here have a row per stratum and level.
    """
    counts = judged.where(F.col(good) == 1).groupBy(stratum).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.col(level_column) > keep).alias(f"k{keep}") for keep in range(STEPS)),
    )
    strata = max(1, counts.count())
    tests = F.array(
        *(F.struct(F.lit(keep).alias("keep"), F.col(f"k{keep}").alias("k")) for keep in reversed(range(STEPS)))
    )
    # A count above the allowed rate can't pass, and its sum would be long.
    passed = F.filter(
        F.filter(tests, lambda t: t["k"] <= F.lit(false_rejection) * F.col("n")),
        lambda t: log_binomial_tail(t["k"], F.col("n"), false_rejection) <= F.log(F.lit(error / strata)),
    )
    # Rejections grow with strictness, and so do the tails: what passed is a prefix of the fixed order.
    return counts.select(
        stratum, F.coalesce(F.array_min(F.transform(passed, lambda t: t["keep"])), F.lit(STEPS)).alias("max_level")
    )


def judge(docs: DataFrame, limits: DataFrame, stratum: str, stats: str, kept: str) -> DataFrame:
    """``docs`` with the boolean ``kept``; ``limits`` is what ``certified_levels`` returns."""
    key, most = own_name("stratum"), own_name("most")
    limits = limits.select(F.col(stratum).alias(key), F.col("max_level").alias(most))
    # One expression, which isn't split into filters that would each compute the statistics again.
    verdict = F.when(base_failed(F.col(stats)), F.lit(False)).otherwise(
        level(F.col(stats)) <= F.coalesce(F.col(most), F.lit(STEPS))
    )
    joined = docs.join(limits, docs[stratum].eqNullSafe(limits[key]), "left")
    return joined.withColumn(kept, verdict).drop(key, most)


def fit(scored: DataFrame, labels: DataFrame, stratum: str, stats: str, **bounds: float) -> DataFrame:
    """Cutoffs for ``judge`` from documents with statistics (doc_id, stratum, stats) and labels.

    Documents that the base rule rejects take no part: they don't depend on cutoffs. A document
    that occurs several times counts once.
    """
    quality = one_label(labels, "quality")
    judged = (
        scored.where(~base_failed(F.col(stats)))
        .select("doc_id", stratum, level(F.col(stats)).alias("level"))
        .join(quality, "doc_id")
        .groupBy("doc_id", stratum, "quality")
        .agg(F.max("level").alias("level"))
    )
    return certified_levels(judged, stratum, "level", "quality", **bounds)
