"""The queries of this subpackage and the SQL that checks them."""

from tillwise.llm import (chat, contamination, html_text, negatives, packing, passages, pieces, quality, secrets,
                          simhash, token_counts, trie, vectors)

QUERIES = {
    "op1_html_extraction": html_text.op1_html_extraction,
    "op4_embedding_near_dedup": vectors.op4_embedding_near_dedup,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op6_benchmark_decontamination": contamination.op6_benchmark_decontamination,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_substring_dedup": passages.op9_substring_dedup,
    "op5_token_counts": token_counts.op5_token_counts,
    "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
    "op10_secret_scans": secrets.op10_secret_scans,
    "op11_best_fit_packing": packing.op11_best_fit_packing,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}

SQL = {
    "op4_embedding_near_dedup": vectors.OP4_SQL,
    "op9_substring_dedup": passages.OP9_SQL,
    "op10_secret_scans": secrets.OP10_SQL,
    "op12_prefix_trie": trie.OP12_SQL,
    "op13_hard_negatives": negatives.OP13_SQL,
}
