"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from ferrytally.llm import (
    conversation_trie, decontaminate, language_id, licenses, mixing, ngram_join, quality_rules, sharding, simhash_neardup, substring_dedup, toxicity, warc, whitening,
)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_benchmark_decontamination": decontaminate.query,
    "op3_source_mixing": mixing.query,
    "op4_warc": warc.query,
    "op5_substring_dedup": substring_dedup.query,
    "op6_sharding": sharding.query,
    "op7_language_id": language_id.query,
    "op8_quality_rules": quality_rules.query,
    "op9_license_scan": licenses.query,
    "op10_simhash_neardup": simhash_neardup.query,
    "op11_conversation_trie": conversation_trie.query,
    "op12_embedding_whitening": whitening.query,
    "op13_ngram_jaccard_join": ngram_join.query,
}

#: Only what SQL can express; the others are tested against plain Python on small tables.
ORACLES: dict[str, str] = {
    "op3_source_mixing": mixing.SQL,
    "op11_conversation_trie": conversation_trie.SQL,
    "op13_ngram_jaccard_join": ngram_join.SQL,
}
