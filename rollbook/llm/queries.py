"""The registered queries of the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.llm import (
    chat, decontaminate, exact, language, license, near, packing, periodic, quality, repeats, resample, template, tokens,
)
from rollbook.llm.oracle import ORACLE, PROBE
from rollbook.llm.shared import once, table
from rollbook.session import fresh_dir

__all__ = ["ORACLE", "QUERIES"]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = quality.fit(docs, labels.where(fold != 2))
    return quality.score(docs, model).select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_text(table(spark, sf_dir, "pages"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(table(spark, sf_dir, "documents"))


def op3_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages too: there the markup declares, and addresses have suffixes and nested hosts."""
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return language.identify_pages(table(spark, sf_dir, "pages"), text).withColumnRenamed("doc_id", "page_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"), license.default_templates(spark))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents"), shingle=2)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents after the benchmark's texts: what both hold is counted once."""
    cache = fresh_dir(spark, "token-cache")
    model = public_tokenizers.path("piece_bpe_32k.model")
    tokens.count_tokens(table(spark, sf_dir, "benchmark"), model, cache, limit=4096, id_col="item_id")
    return tokens.count_tokens(table(spark, sf_dir, "documents"), model, cache, limit=4096)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql(
        f"SELECT -1L AS conv_id, turn, role, '{PROBE}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    done = chat.format_conversations(rows.unionByName(probe))
    joined = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    done = once(done, "loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(joined, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "identical",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
    # Every tenth text goes on periodically from one of its words.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = once(docs, "words", F.when(F.col("h") % 10 == 0, words))
    docs = docs.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    start = F.when(F.col("n") > 0, F.expr("g % n"))
    docs = once(docs, "a", start)
    docs = once(docs, "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    periodic_text = F.array_join(F.expr("transform(words, (w, i) -> if(i < a, w, element_at(words, int(1 + a + (i - a) % p))))"), " ")
    text = F.when(F.col("n") > 0, periodic_text).otherwise(F.col("text"))
    found = periodic.find_runs(docs.select("doc_id", text.alias("text")))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.find_repeats(table(spark, sf_dir, "documents"), least=200).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_main_text": op2_main_text,
    "op3_language": op3_language,
    "op3_page_language": op3_page_language,
    "op4_license_scan": op4_license_scan,
    "op5_pack": op5_pack,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_chat_format": op9_chat_format,
    "op10_decontaminate": op10_decontaminate,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_repeats": op12_repeats,
    "op13_resample": op13_resample,
}
