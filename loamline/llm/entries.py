"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from . import decontamination, lm_scoring, near_dedup, pieces, pii, quality_rules, repeats, sharding, url_filters, warc

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op7_benchmark_decontamination": decontamination.op7_benchmark_decontamination,
    "op8_sharding": sharding.op8_sharding,
    "op2_lm_scoring": lm_scoring.op2_lm_scoring,
    "op3_warc": warc.op3_warc,
    "op4_pii": pii.op4_pii,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_url_filters": url_filters.op6_url_filters,
    "op9_minhash_near_dedup": near_dedup.op9_minhash_near_dedup,
    "op10_suffix_array_dedup": repeats.op10_suffix_array_dedup,
}
SQL = {"op6_url_filters": url_filters.OP6_SQL}
