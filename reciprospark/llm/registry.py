"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from reciprospark.llm import bpe, decontaminate, infill, lm, minhash, outliers, pieces, quotes, rules, simhash, toxicity, trie, urls

QUERIES = {
    "op1_pitman_yor": lm.op1_pitman_yor,
    "op2_rule_ensemble": rules.op2_rule_ensemble,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_outliers": outliers.op4_outliers,
    "op5_url_filter": urls.op5_url_filter,
    "op6_simhash": simhash.op6_simhash,
    "op7_token_counts": pieces.op7_token_counts,
    "op8_bpe": bpe.op8_bpe,
    "op9_quote_links": quotes.op9_quote_links,
    "op10_weak_supervision": toxicity.op10_weak_supervision,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_minhash": minhash.op12_minhash,
    "op13_infill": infill.op13_infill,
}
ORACLES = {
    "op3_decontamination": decontaminate.ORACLE,
    "op5_url_filter": urls.ORACLE,
    "op9_quote_links": quotes.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op12_minhash": minhash.ORACLE,
    "op13_infill": infill.ORACLE,
}
