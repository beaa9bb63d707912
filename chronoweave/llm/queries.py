"""Registered queries of the training-data operators, and their SQL where there is one."""

from __future__ import annotations

from chronoweave.llm.alignment import op12_tokenizer_alignment
from chronoweave.llm.byte_bpe import op2_byte_bpe
from chronoweave.llm.conversations import op11_conversation_repair
from chronoweave.llm.fingerprints import op5_order_minhash
from chronoweave.llm.jaccard_join import op13_ngram_join
from chronoweave.llm.near_dedup import op9_near_dedup
from chronoweave.llm.oracles import ORACLE_SQL
from chronoweave.llm.packing import op7_best_fit_packing
from chronoweave.llm.quality import op4_quality
from chronoweave.llm.substring_dedup import op1_substring_dedup
from chronoweave.llm.token_files import op3_token_files
from chronoweave.llm.top_k import op10_top_k
from chronoweave.llm.toxicity import op8_toxicity
from chronoweave.llm.url_filters import op6_url_filters

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_token_files": op3_token_files,
    "op4_quality": op4_quality,
    "op5_order_minhash": op5_order_minhash,
    "op6_url_filters": op6_url_filters,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_toxicity": op8_toxicity,
    "op9_near_dedup": op9_near_dedup,
    "op10_top_k": op10_top_k,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_ngram_join": op13_ngram_join,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
