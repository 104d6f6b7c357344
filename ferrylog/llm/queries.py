"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers

from ferrylog.llm import (bpe, conversations, language, licences, lines, minhash, packing, quality, repeats,
                          sharding, spelling, token_counts, topk)


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark, sf_dir):
    return language.identify(_documents(spark, sf_dir))


def op2_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digest(_documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op3_jump_sharding(spark, sf_dir):
    return sharding.shard_documents(_documents(spark, sf_dir), 40)


def op4_swap_packing(spark, sf_dir):
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_quality_divergence(spark, sf_dir):
    return quality.quality_report(_documents(spark, sf_dir))


def op6_token_counts(spark, sf_dir):
    return token_counts.token_report(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_minmax_dedup(spark, sf_dir):
    return minhash.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))


def op8_license_scan(spark, sf_dir):
    return licences.licence_report(_documents(spark, sf_dir))


def op9_substring_dedup(spark, sf_dir):
    return repeats.digest(_documents(spark, sf_dir))


def op10_pivot_topk(spark, sf_dir):
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_line_dedup(spark, sf_dir):
    return lines.digest(_documents(spark, sf_dir))


def op12_conversation_repair(spark, sf_dir):
    return conversations.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(_documents(spark, sf_dir))


QUERIES = {q.__name__: q for q in (
    op1_language_id, op2_byte_bpe, op3_jump_sharding, op4_swap_packing, op5_quality_divergence, op6_token_counts,
    op7_minmax_dedup, op8_license_scan, op9_substring_dedup, op10_pivot_topk, op11_line_dedup, op12_conversation_repair,
    op13_spelling_variants)}
SQL = {"op3_jump_sharding": sharding.SHARD_SQL, "op8_license_scan": licences.LICENCE_SQL,
       "op11_line_dedup": lines.LINES_SQL, "op12_conversation_repair": conversations.REPAIR_SQL,
       "op13_spelling_variants": spelling.VARIANTS_SQL}
