"""The queries of this package and their DuckDB equivalents."""

from __future__ import annotations

from . import chat_format, exact_dedup, hard_negatives, importance, language_id, license_scan, line_dedup, ngram_join, packing, sharding, subword_sampling, vector_search, warc


def queries() -> dict:
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_ngram_join": ngram_join.op2_ngram_join,
        "op3_top_k": vector_search.op3_top_k,
        "op4_warc": warc.op4_warc,
        "op5_language_id": language_id.op5_language_id,
        "op6_subword_sampling": subword_sampling.op6_subword_sampling,
        "op7_chat_format": chat_format.op7_chat_format,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op9_packing": packing.op9_packing,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_importance_resampling": importance.op12_importance_resampling,
        "op13_license_scan": license_scan.op13_license_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_ngram_join": ngram_join.OP2_SQL,
        "op3_top_k": vector_search.OP3_SQL,
        "op4_warc": warc.OP4_SQL,
        "op7_chat_format": chat_format.OP7_SQL,
        "op8_line_dedup": line_dedup.OP8_SQL,
        "op10_exact_dedup": exact_dedup.OP10_SQL,
        "op11_hard_negatives": hard_negatives.OP11_SQL,
        "op12_importance_resampling": importance.OP12_SQL,
        "op13_license_scan": license_scan.op13_sql(),
    }
