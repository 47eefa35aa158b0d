"""The ``opN_<name>`` queries and their DuckDB SQL."""

from __future__ import annotations

from odometrix.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from odometrix.llm.html_blocks import op5_html_extraction
from odometrix.llm.lm_scoring import op7_lm_scoring
from odometrix.llm.mixing import op2_mix_sources
from odometrix.llm.packing import op1_best_fit_packing
from odometrix.llm.phrase_index import OP11_SQL, op11_benchmark_decontamination
from odometrix.llm.prefix_trie import OP12_SQL, op12_conversation_prefix_trie
from odometrix.llm.quality import OP3_SQL, op3_quality_rules
from odometrix.llm.secret_scan import op4_secret_scans
from odometrix.llm.shards import op9_sharding
from odometrix.llm.simhash import op8_simhash_near_dedup
from odometrix.llm.spelling import OP13_SQL, op13_spelling_variants
from odometrix.llm.substring_dedup import op6_suffix_array_dedup

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_scans": op4_secret_scans,
    "op5_html_extraction": op5_html_extraction,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_sharding": op9_sharding,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_benchmark_decontamination": op11_benchmark_decontamination,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}

# The others have no SQL that runs on whole tables: their rows hang on entropy
# windows, hashes, search orders, trained models or every byte position.
# tests/llm holds them against brute force instead.
ORACLE_SQL = {
    "op3_quality_rules": OP3_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_benchmark_decontamination": OP11_SQL,
    "op12_conversation_prefix_trie": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
