"""The numbered queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from silverlake.llm import (
    byte_bpe,
    chunk_dedup,
    lang_centroids,
    merkle,
    mixing,
    ngram_join,
    ordinal_toxicity,
    pfor_ids,
    pstable_ann,
    pu_quality,
    trie_lm,
    turn_repair,
    url_trees,
)

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_pu_quality": pu_quality.op2_pu_quality,
    "op3_trie_lm": trie_lm.op3_trie_lm,
    "op4_byte_bpe": byte_bpe.op4_byte_bpe,
    "op5_url_trees": url_trees.op5_url_trees,
    "op6_ordinal_toxicity": ordinal_toxicity.op6_ordinal_toxicity,
    "op7_pstable_ann": pstable_ann.op7_pstable_ann,
    "op8_chunk_dedup": chunk_dedup.op8_chunk_dedup,
    "op9_pfor_ids": pfor_ids.op9_pfor_ids,
    "op10_mixing": mixing.op10_mixing,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_lang_centroids": lang_centroids.op12_lang_centroids,
    "op13_turn_repair": turn_repair.op13_turn_repair,
}
SQL = {
    "op8_chunk_dedup": chunk_dedup.SQL,
    "op10_mixing": mixing.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op13_turn_repair": turn_repair.SQL,
}
