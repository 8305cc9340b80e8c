"""Registered queries of the text operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywatch.llm import compression
from paywatch.llm.common import table
from paywatch.llm.doubling import drop_repeats
from paywatch.llm.exact_dedup import exact_groups
from paywatch.llm.factorisation import held_out, score_quality, train_machine
from paywatch.llm.html_blocks import extract_text
from paywatch.llm.lattice import score_texts
from paywatch.llm.line_dedup import drop_boilerplate
from paywatch.llm.mixing import mixture
from paywatch.llm.recompression import periodic_runs, planted
from paywatch.llm.simhash import simhash_groups
from paywatch.llm.spelling import misspelt, spelling_variants
from paywatch.llm.suffix import drop_repeated_bytes
from paywatch.llm.wu_manber import benchmark_hits


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_bytes(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return score_texts(table(spark, sf_dir, "documents"), fold)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"], nameless=True)
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    machine = train_machine(docs, table(spark, sf_dir, "labels"))
    found = score_quality(docs, machine, keep=["doc_id"]).select("row.doc_id", "score")
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), change=misspelt)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    detector = compression.train_detector(docs, table(spark, sf_dir, "labels"))
    found = compression.score_toxicity(docs, detector, keep=["doc_id"]).select("row.doc_id", "score")
    return found.select(
        "doc_id", compression.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), change=planted, full=False)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_html_extraction": op3_html_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_source_mixing": op8_source_mixing,
    "op9_simhash": op9_simhash,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
}
