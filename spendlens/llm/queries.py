"""The registered queries of this subpackage and their SQL counterparts."""

from spendlens.llm import (
    covers, divergence, langid, pii, positional, secrets, simhash, suffixes, suffixtree, topk, toxicity, tries, wordtable)

QUERIES = {
    "op1_exact_top_k": topk.op1,
    "op2_suffix_tree_scores": suffixtree.op2,
    "op3_nearest_centroid_language": langid.op3,
    "op4_pii_deobfuscation": pii.op4,
    "op5_nearest_toxic_examples": toxicity.op5,
    "op6_secret_forest": secrets.op6,
    "op7_simhash_near_dedup": simhash.op7,
    "op8_benchmark_decontamination": positional.op8,
    "op9_bpe_word_table": wordtable.op9,
    "op10_suffix_dedup": suffixes.op10,
    "op11_conversation_trie": tries.op11,
    "op12_cover_dedup": covers.op12,
    "op13_source_divergence": divergence.op13,
}

ORACLES: dict[str, str] = {
    "op1_exact_top_k": topk.SQL,
    "op10_suffix_dedup": suffixes.SQL,
    "op11_conversation_trie": tries.SQL,
    "op12_cover_dedup": covers.SQL,
    "op13_source_divergence": divergence.SQL,
}
