"""The registered queries of these operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from areaweave.llm import (
    embeddings, html_text, language_id, neighbours, packing, pieces, prefix_trie, ranked_search,
    simhash, substrings, tokens, toxicity, urls,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": embeddings.op1_embedding_near_dedup,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_nearest_neighbours": neighbours.op6_nearest_neighbours,
    "op7_token_counts": tokens.op7_token_counts,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_html_extraction": html_text.op9_html_extraction,
    "op10_url_filters": urls.op10_url_filters,
    "op11_language_id": language_id.op11_language_id,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": embeddings.OP1_SQL,
    "op8_substring_dedup": substrings.OP8_SQL,
    "op10_url_filters": urls.OP10_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
