"""The numbered queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from takerlens.llm.op1_pii import op1_offset_preserving_pii
from takerlens.llm.op2_ppm import op2_prediction_by_partial_matching
from takerlens.llm.op3_secrets import op3_randomness_battery
from takerlens.llm.op4_tokens import op4_distinct_pretoken_counts
from takerlens.llm.op5_templates import op5_log_template_lines
from takerlens.llm.op6_packing import op6_sum_of_squares_packing
from takerlens.llm.op7_jaccard import op7_bayesian_jaccard_join
from takerlens.llm.op8_exact import OP8_SQL, op8_streaming_exact_dedup
from takerlens.llm.op9_isolation import op9_isolation_forest
from takerlens.llm.op10_sentencepiece import op10_distinct_chunk_pieces
from takerlens.llm.op11_fmindex import OP11_SQL, op11_fm_index_collocations
from takerlens.llm.op12_whitening import op12_polarised_whitening
from takerlens.llm.op13_linkgraph import OP13_SQL, op13_link_graph_filter

QUERIES = {f.__name__: f for f in (
    op1_offset_preserving_pii, op2_prediction_by_partial_matching, op3_randomness_battery, op4_distinct_pretoken_counts,
    op5_log_template_lines, op6_sum_of_squares_packing, op7_bayesian_jaccard_join, op8_streaming_exact_dedup,
    op9_isolation_forest, op10_distinct_chunk_pieces, op11_fm_index_collocations, op12_polarised_whitening,
    op13_link_graph_filter)} | {"pipeline": corpus_pipeline.run}
ORACLE_SQL: dict[str, str] = {"op8_streaming_exact_dedup": OP8_SQL, "op11_fm_index_collocations": OP11_SQL,
                              "op13_link_graph_filter": OP13_SQL}
