"""The registered queries of this folder and their SQL twins where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tripmill.llm import exact_dedup, filter_audit, fingerprints, html_text, language_id, line_dedup, mixing, near_dedup, packing, prefix_trie, sharding, substring_dedup, toxicity

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_fingerprints": fingerprints.op4_fingerprints,
    "op5_mixing": mixing.op5_mixing,
    "op6_html_text": html_text.op6_html_text,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_sharding": sharding.op8_sharding,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_packing": packing.op10_packing,
    "op11_language_id": language_id.op11_language_id,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_filter_audit": filter_audit.op13_filter_audit,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
