"""Registered queries of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from loglake.llm.ball_tree import OP12_SQL, op12_ball_tree_search
from loglake.llm.bpe import op6_distinct_word_bpe
from loglake.llm.chat import OP1_SQL, op1_chat_format
from loglake.llm.fingerprint import op4_weighted_sampling
from loglake.llm.hilbert import op9_hilbert_shards
from loglake.llm.hmm import op5_hidden_markov
from loglake.llm.neardup import op2_lsh_forest
from loglake.llm.packing import op7_min_bin_slack
from loglake.llm.prefix_counts import op11_prefix_token_counts
from loglake.llm.quality import op10_quality_rules
from loglake.llm.toxicity import op8_gru_toxicity
from loglake.llm.wavelet import op3_wavelet_tokens
from loglake.llm.whitening import op13_bidiagonal_whitening

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op4_weighted_sampling": op4_weighted_sampling,
    "op5_hidden_markov": op5_hidden_markov,
    "op6_distinct_word_bpe": op6_distinct_word_bpe,
    "op2_lsh_forest": op2_lsh_forest,
    "op8_gru_toxicity": op8_gru_toxicity,
    "op3_wavelet_tokens": op3_wavelet_tokens,
    "op7_min_bin_slack": op7_min_bin_slack,
    "op1_chat_format": op1_chat_format,
    "op9_hilbert_shards": op9_hilbert_shards,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_token_counts": op11_prefix_token_counts,
    "op12_ball_tree_search": op12_ball_tree_search,
    "op13_bidiagonal_whitening": op13_bidiagonal_whitening,
}

#: the rest needs tokenizers, trained models or approximate search: tests/llm compares those with brute force
ORACLE: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op12_ball_tree_search": OP12_SQL,
}
