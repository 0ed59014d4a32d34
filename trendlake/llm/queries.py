"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import (
    decontamination,
    license_scan,
    mixing,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    repeats,
    simhash,
    spelling,
    token_counts,
    topk,
    vector_codes,
)
from trendlake.llm.common import table, word_count
from trendlake.llm.sql import SQL  # noqa: F401
from trendlake.shared import materialize


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document; strata are languages."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = docs.select("doc_id", "lang", quality_rules.statistics("text").alias("stats"))
    scored = materialize(scored, "quality-statistics")
    limits = quality_rules.fit(scored, labels, "lang", "stats")
    judged = quality_rules.judge(scored, limits, "lang", "stats", "kept")
    stats = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *(F.col("stats")[c].alias(c) for c in stats), quality_rules.base_failed(F.col("stats")).alias("base_failed"), "kept"
    )

#: Stands for the secret that a user brings.
PSEUDONYM_KEY = "key for the registered query"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents")
    tokens = packing.tokenize(docs, tokenizer_path("word_bpe_49k.json"), 1, "doc_id")
    pieces = packing.pack(tokens, groups=packing.group_count(docs))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the license templates they contain."""
    return license_scan.license_matches(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", pii.pseudonymize(F.col("text"), PSEUDONYM_KEY).alias("text"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model that has seen two of three folds of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = quality_classifier.fold(F.col("doc_id"))
    model = quality_classifier.fit(docs, labels.where(fold != 1))
    return quality_classifier.score(docs, model, "doc_id").select(
        "doc_id",
        F.coalesce(fold == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy pieces of every document."""
    vocabulary = token_counts.ranked_vocabulary(tokenizer_path("byte_bpe_50k.tiktoken"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by weights 5, 2, 1 takes of every document."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, word_count("text")).select("doc_id", "size", "source_size", "target", "taken")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 200 bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every twentieth vector."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk.whole_numbers(F.col("embedding")).alias("v")
    )
    return topk.top_k(rows, rows.where(F.col("id") % 20 == 0), 20)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside of benchmark passages of ten words."""
    index = decontamination.build_index(table(spark, sf_dir, "documents"))
    return decontamination.contamination(index, decontamination.phrases_of(table(spark, sf_dir, "benchmark")))


def slipped_words(docs: DataFrame, every: int = 199) -> DataFrame:
    """A ``word`` per run of letters; where ``every`` divides the run's checksum one letter is missing. A null doc_id is empty."""
    run = F.explode(spelling.runs_of("text"))
    summed = docs.select("doc_id", run.alias("run")).withColumn(
        "h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    )
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return summed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents with its most frequent neighbour and the root of its group."""
    words = spelling.count_words(slipped_words(table(spark, sf_dir, "documents")), 6, 5)
    return spelling.variant_groups(words, 5)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four parts for every vector, with errors and the codebooks' digest."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "label", topk.whole_numbers(F.col("embedding"), 1024).alias("v")
    )
    vectors, length = vector_codes.filled(rows, 4)
    books = vector_codes.train(vectors, length, parts=4, entries=256, rounds=4)
    coded = materialize(vector_codes.encode(vectors, books), "vector-codes")
    hexadecimal = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return vector_codes.group_errors(coded, "label", "label_error").select(
        F.col("id").alias("vec_id"),
        hexadecimal.alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_license_scan": op3_license_scan,
    "op4_pii": op4_pii,
    "op5_simhash": op5_simhash,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_repeats": op9_repeats,
    "op10_top_k": op10_top_k,
    "op11_decontamination": op11_decontamination,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_vector_codes": op13_vector_codes,
}
