"""The registered queries of this package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from panelkit.llm import byte_bpe, embedding_links, near_text, packing, periodic, quality_model, quality_rules, repeats, secrets, sharding, token_files, token_groups, top_search

QUERIES = {
    "op1_byte_bpe": byte_bpe.op1_byte_bpe,
    "op2_order_minhash": near_text.op2_order_minhash,
    "op3_embedding_links": embedding_links.op3_embedding_links,
    "op4_quality_model": quality_model.op4_quality_model,
    "op5_sharding": sharding.op5_sharding,
    "op6_suffix_repeats": repeats.op6_suffix_repeats,
    "op7_token_files": token_files.op7_token_files,
    "op8_packing": packing.op8_packing,
    "op9_secret_scans": secrets.op9_secret_scans,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_top_search": top_search.op12_top_search,
    "op13_token_groups": token_groups.op13_token_groups,
}

ORACLE = {
    "op3_embedding_links": embedding_links.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op12_top_search": top_search.ORACLE,
}
