"""The queries of this subpackage, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from millrace.llm import chat_format, chunked_bpe, cross_align, decontaminate, exact_dedup, fill_middle, license_scan, near_dup, piece_fst, token_counts, token_shards, toxicity, url_filter

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_sentencepiece": piece_fst.op2_sentencepiece,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_token_shards": token_shards.op5_token_shards,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_chat_format": chat_format.op8_chat_format,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "op10_near_dedup": near_dup.op10_near_dedup,
    "op11_cross_align": cross_align.op11_cross_align,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_byte_bpe": chunked_bpe.op13_byte_bpe,
}

ORACLES = {
    "op4_url_filter": url_filter.ORACLE,
    "op6_license_scan": license_scan.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op8_chat_format": chat_format.ORACLE,
    "op9_benchmark_decontamination": decontaminate.ORACLE,
    "op12_fill_middle": fill_middle.ORACLE,
}
