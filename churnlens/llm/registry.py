"""The queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from churnlens.llm.brown_lm import op7_lm_scoring
from churnlens.llm.line_dedup import OP8_SQL, op8_line_dedup
from churnlens.llm.lsh_search import op5_nearest
from churnlens.llm.mixing import OP4_SQL, op4_mixing
from churnlens.llm.personal import op9_personal_data
from churnlens.llm.pieces import op6_sentencepiece
from churnlens.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from churnlens.llm.quality import OP3_SQL, op3_quality_rules
from churnlens.llm.sharding import OP10_SQL, op10_sharding
from churnlens.llm.simhash import op2_simhash
from churnlens.llm.token_counts import op12_token_counts
from churnlens.llm.url_filter import OP1_SQL, op1_url_filters
from churnlens.llm.vector_codes import OP11_SQL, op11_vector_codes

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_nearest": op5_nearest,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_line_dedup": op8_line_dedup,
    "op9_personal_data": op9_personal_data,
    "op10_sharding": op10_sharding,
    "op11_vector_codes": op11_vector_codes,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE = {
    "op1_url_filters": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op4_mixing": OP4_SQL,
    "op8_line_dedup": OP8_SQL,
    "op10_sharding": OP10_SQL,
    "op11_vector_codes": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
