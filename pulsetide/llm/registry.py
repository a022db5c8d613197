"""The queries of this package, and their SQL twins where SQL can say the same."""

from pulsetide.llm import (
    byte_bpe,
    collocations,
    conversation_trie,
    exact_dedup,
    language_id,
    line_dedup,
    ngram_jaccard,
    packing,
    suffix_dedup,
    token_store,
    topk_search,
    url_filters,
    warc_revisits,
)

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_ngram_jaccard": ngram_jaccard.op2_ngram_jaccard,
    "op3_suffix_array_dedup": suffix_dedup.op3_suffix_array_dedup,
    "op4_byte_bpe": byte_bpe.op4_byte_bpe,
    "op5_language_id": language_id.op5_language_id,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_warc_revisits": warc_revisits.op7_warc_revisits,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_topk_search": topk_search.op9_topk_search,
    "op10_packing": packing.op10_packing,
    "op11_token_store": token_store.op11_token_store,
    "op12_collocations": collocations.op12_collocations,
    "op13_conversation_trie": conversation_trie.op13_conversation_trie,
}

ORACLES = {
    "op1_url_filters": url_filters.ORACLE,
    "op2_ngram_jaccard": ngram_jaccard.ORACLE,
    "op3_suffix_array_dedup": suffix_dedup.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op7_warc_revisits": warc_revisits.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op9_topk_search": topk_search.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}
