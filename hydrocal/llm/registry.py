"""The queries of this package and their DuckDB SQL, for ``__spark_entry__``."""

from __future__ import annotations

from hydrocal.llm import chat_format, lexical_search, mixing, quality_rules, sharding, url_cascade, vector_codes
from hydrocal.llm.chat_format import op13_incremental_rendering
from hydrocal.llm.lexical_search import op12_pair_bound_maxscore
from hydrocal.llm.minhash_dedup import op2_superminhash_dedup
from hydrocal.llm.mixing import op4_weighted_mixing
from hydrocal.llm.packing import op6_residual_packing
from hydrocal.llm.pq_dedup import op10_pq_dedup
from hydrocal.llm.pu_quality import op8_pu_quality
from hydrocal.llm.quality_rules import op7_line_frequency
from hydrocal.llm.sharding import op3_permutation_sharding
from hydrocal.llm.substring_dedup import op5_substring_dedup
from hydrocal.llm.token_rans import op1_token_rans
from hydrocal.llm.url_cascade import op9_bloom_cascade
from hydrocal.llm.vector_codes import op11_adaptive_bounds_codes

QUERIES = {
    f.__name__: f
    for f in (
        op1_token_rans, op2_superminhash_dedup, op3_permutation_sharding, op4_weighted_mixing, op5_substring_dedup,
        op6_residual_packing, op7_line_frequency, op8_pu_quality, op9_bloom_cascade, op10_pq_dedup,
        op11_adaptive_bounds_codes, op12_pair_bound_maxscore, op13_incremental_rendering,
    )
}
ORACLE_SQL = {
    "op3_permutation_sharding": sharding.ORACLE_SQL,
    "op4_weighted_mixing": mixing.ORACLE_SQL,
    "op7_line_frequency": quality_rules.ORACLE_SQL,
    "op9_bloom_cascade": url_cascade.ORACLE_SQL,
    "op11_adaptive_bounds_codes": vector_codes.ORACLE_SQL,
    "op12_pair_bound_maxscore": lexical_search.ORACLE_SQL,
    "op13_incremental_rendering": chat_format.ORACLE_SQL,
}
