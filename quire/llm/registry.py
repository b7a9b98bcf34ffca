"""The corpus operators' queries and their SQL, for ``__spark_entry__.py``."""

from quire.llm import arrow_tokens, conversation_trie, entropy_mix, hnsw, lang_embed, line_runs, merkle_manifest, pfp_dedup, pii_disclosure, simhash_ball, suffix_decontam, token_counts, url_markov

QUERIES = {
    "op1_hnsw_ann": hnsw.op1,
    "op2_simhash_ball": simhash_ball.op2,
    "op3_pii_disclosure": pii_disclosure.op3,
    "op4_line_runs": line_runs.op4,
    "op5_suffix_decontam": suffix_decontam.op5,
    "op6_url_markov": url_markov.op6,
    "op7_entropy_mix": entropy_mix.op7,
    "op8_lang_embed": lang_embed.op8,
    "op9_arrow_tokens": arrow_tokens.op9,
    "op10_pfp_dedup": pfp_dedup.op10,
    "op11_merkle_manifest": merkle_manifest.op11,
    "op12_conversation_trie": conversation_trie.op12,
    "op13_token_counts": token_counts.op13,
}
SQL = {
    "op4_line_runs": line_runs.OP4_SQL,
    "op5_suffix_decontam": suffix_decontam.OP5_SQL,
    "op7_entropy_mix": entropy_mix.OP7_SQL,
    "op11_merkle_manifest": merkle_manifest.OP11_SQL,
    "op12_conversation_trie": conversation_trie.OP12_SQL,
}
