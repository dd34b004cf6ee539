"""Queries ``op<N>_<name>`` over the driver's tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.llm import (bpe, chat, ctw, filter_audit, gam, kdtree, line_dedup, mixing, ngram_join,
                       periodic, quality_rules, suffix_dedup, super_minhash)
from berth.llm.common import SPACE, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed vocabulary files keep ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op1_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_additive_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    marks = labels.where(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    scored = gam.score(docs, gam.train(docs, marks), fold(F.col("doc_id"), 5) == 0)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op4_pareto_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit(chat.END + chat.START + "assistant ok")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_conversations(turns))


def op7_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), whole=True)
    return kept.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                       F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op8_decision_list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kdtree.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return kdtree.top_k(vectors, F.col("id") % 20 == 0, k=20)


def op10_context_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7) == 2)


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The contract's input of op11: a tenth of the texts, by crc32 of the id, repeat a
    stretch of their words to the end; the others, and texts without words, stay."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def tail(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))), " ")

    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    return F.when((h % 10 == 0) & text.rlike(f"[^{SPACE}]"), F.get(F.transform(F.array(words), tail), F.lit(0))).otherwise(text)


def op11_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic.digests(periodic.find_runs(docs.select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text"))))


def op12_super_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_minhash.near_duplicates(table(spark, sf_dir, "documents"), k=5, percent=85)


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    facts, tables = filter_audit.failing_ids(docs, labels, filter_audit.text_rules(F.coalesce("text", F.lit(""))), copies="E")
    return filter_audit.audit(facts, tables)


#: name -> (query, DuckDB twin or None)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_chunk_reuse_bpe": (op1_chunk_reuse_bpe, None),
    "op2_additive_quality_model": (op2_additive_quality_model, None),
    "op3_signature_tree_join": (op3_signature_tree_join, None),
    "op4_pareto_source_mix": (op4_pareto_source_mix, mixing.ORACLE_SQL),
    "op5_suffix_repeats": (op5_suffix_repeats, None),
    "op6_chat_format": (op6_chat_format, chat.ORACLE_SQL),
    "op7_fuzzy_line_dedup": (op7_fuzzy_line_dedup, None),
    "op8_decision_list_rules": (op8_decision_list_rules, None),
    "op9_kd_tree_top_k": (op9_kd_tree_top_k, kdtree.ORACLE_SQL),
    "op10_context_tree_score": (op10_context_tree_score, None),
    "op11_maximal_pair_runs": (op11_maximal_pair_runs, None),
    "op12_super_minhash_dedup": (op12_super_minhash_dedup, None),
    "op13_filter_interaction_audit": (op13_filter_interaction_audit, filter_audit.ORACLE_SQL),
}
