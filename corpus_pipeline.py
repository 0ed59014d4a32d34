"""The training corpus: stages over ``documents``, each written as Parquet and read again.

Defined cases, of every stage: an empty table gives an empty table; columns besides those of ``documents`` are carried
along under their names; a null text counts as empty and stays null where its row stays; a null doc_id is an id like any
other; equal rows are judged alike, and the near-duplicate stage keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import mixing, packing, pii, quality_rules, simhash
from trendlake.llm.common import own_name, table, word_count
from trendlake.llm.queries import PSEUDONYM_KEY, tokenizer_path
from trendlake.shared import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the certified cutoffs of their language."""
    stats, kept = own_name("stats"), own_name("kept")
    # With their statistics once, so that judging them doesn't count again.
    scored = materialize(docs.withColumn(stats, quality_rules.statistics("text")), "quality-statistics")
    numbers = scored.select("doc_id", "lang", stats)
    limits = materialize(quality_rules.fit(numbers, table(spark, sf_dir, "labels"), "lang", stats), "quality-limits")
    judged = quality_rules.judge(scored, limits, "lang", stats, kept)
    return judged.where(F.col(kept)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints: three-word shingles, links of two bits at most."""
    return simhash.one_per_component(docs, simhash.RADIUS)


def with_length(docs: DataFrame) -> DataFrame:
    """Keeps the number of characters true to the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms."""
    return with_length(docs.withColumn("text", pii.pseudonymize(F.col("text"), PSEUDONYM_KEY))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the sources by weight: repeated, left out, or cut at the word where a budget ends."""
    return with_length(mixing.mixed_rows(docs, word_count("text"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and places in sequences."""
    tokens = packing.tokenize(docs, tokenizer_path("word_bpe_49k.json"), 1, "doc_id")
    return packing.pack(tokens, packing.group_count(docs))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("pii", private),
    ("mixing", mix),
    ("packing", pack),
]

#: Packing needs a tokenizer, which SQL has not; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
