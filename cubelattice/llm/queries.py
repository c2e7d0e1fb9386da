"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from cubelattice.llm import bpe, clustering, embedding, exact_dedup, language, licenses, lines, packing, prefix_trie, scoring, sharding, simhash, token_files

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_packing": packing.op2_packing,
    "op3_simhash": simhash.op3_simhash,
    "op4_sharding": sharding.op4_sharding,
    "op5_scoring": scoring.op5_scoring,
    "op6_embedding": embedding.op6_embedding,
    "op7_lines": lines.op7_lines,
    "op8_licenses": licenses.op8_licenses,
    "op9_bpe": bpe.op9_bpe,
    "op10_language": language.op10_language,
    "op11_token_files": token_files.op11_token_files,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_clusters": clustering.op13_clusters,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op4_sharding": sharding.ORACLE,
    "op7_lines": lines.ORACLE,
    "op8_licenses": licenses.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_clusters": clustering.ORACLE,
}
