"""The registered queries of this package and their SQL."""

from __future__ import annotations

from telemetry_lake.llm import (
    byte_bpe,
    decontaminate,
    embedding_dedup,
    fingerprints,
    language_id,
    lm_scoring,
    pii,
    prefix_trie,
    secret_scan,
    simhash_dedup,
    suffix_dedup,
    token_alignment,
    warc,
)

QUERIES = {
    "op1_secret_scan": secret_scan.op1_secret_scan,
    "op2_byte_bpe": byte_bpe.op2_byte_bpe,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_warc": warc.op5_warc,
    "op6_lm_scoring": lm_scoring.op6_lm_scoring,
    "op7_simhash_dedup": simhash_dedup.op7_simhash_dedup,
    "op8_pii": pii.op8_pii,
    "op9_language_id": language_id.op9_language_id,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_embedding_dedup": embedding_dedup.op13_embedding_dedup,
}
ORACLE_SQL = {
    "op1_secret_scan": secret_scan.ORACLE_SQL,
    "op4_decontaminate": decontaminate.ORACLE_SQL,
    "op5_warc": warc.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
}
