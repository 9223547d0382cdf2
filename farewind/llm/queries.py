"""Registered queries of the operators here; each reads its whole table and returns every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farewind.llm import (
    chat,
    decontaminate,
    language,
    main_text,
    mixing,
    mixing_model,
    near_dups,
    prefix_trie,
    quality,
    spelling,
    sql,
    suffix_dedup,
    token_counts,
    warc,
)
from farewind.scratch import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.deduplicate(_table(spark, sf_dir, "documents"), size=2)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archive")
    warc.write_archive(_table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return decontaminate.digest(found)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.mix(docs, _table(spark, sf_dir, "labels")).drop("text")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(_table(spark, sf_dir, "conversations"))


def op7_mixing_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_model.score_documents(_table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(_table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge_documents(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op10_token_counts(
    spark: SparkSession, sf_dir: str, vocabulary: str = "/opt/tokenizers/piece_bpe_32k.model"
) -> DataFrame:
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), token_counts.read_vocabulary(vocabulary)
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(_table(spark, sf_dir, "conversations")).drop("k1", "k2")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_language": (op1_language, None),
    "op2_near_dups": (op2_near_dups, sql.NEAR_DUPS),
    "op3_warc": (op3_warc, sql.WARC),
    "op4_decontaminate": (op4_decontaminate, sql.DECONTAMINATE),
    "op5_mixing": (op5_mixing, None),
    "op6_chat": (op6_chat, sql.CHAT),
    "op7_mixing_model": (op7_mixing_model, None),
    "op8_main_text": (op8_main_text, None),
    "op9_quality": (op9_quality, sql.QUALITY),
    "op10_token_counts": (op10_token_counts, None),
    "op11_spelling": (op11_spelling, sql.SPELLING),
    "op12_prefix_trie": (op12_prefix_trie, sql.PREFIX_TRIE),
    "op13_suffix_dedup": (op13_suffix_dedup, None),
}
