"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from termflow.llm.extendible_hash import exact_copies_query
from termflow.llm.grid_codes import grid_codes_query
from termflow.llm.jaccard_join import jaccard_query
from termflow.llm.language import language_query
from termflow.llm.line_runs import line_runs_query
from termflow.llm.main_text import main_text_query
from termflow.llm.oracles import ORACLES
from termflow.llm.packing import packing_query
from termflow.llm.prefix_tokens import prefix_tokens_query
from termflow.llm.quality import quality_query
from termflow.llm.quantised import near_vectors_query
from termflow.llm.repeated_phrases import repeated_phrases_query
from termflow.llm.token_blocks import token_blocks_query
from termflow.llm.whitening import whitening_query

QUERIES = {
    "op1_repair_token_blocks": token_blocks_query,
    "op2_suffix_line_runs": line_runs_query,
    "op3_universe_partition_jaccard": jaccard_query,
    "op4_hyperdimensional_language": language_query,
    "op5_repeated_phrase_automata": repeated_phrases_query,
    "op6_prefix_table_pieces": prefix_tokens_query,
    "op7_quantised_near_vectors": near_vectors_query,
    "op8_best_fit_packing": packing_query,
    "op9_line_block_main_text": main_text_query,
    "op10_distribution_quality": quality_query,
    "op11_extendible_hash_copies": exact_copies_query,
    "op12_memoised_grid_codes": grid_codes_query,
    "op13_sliced_whitening": whitening_query,
}
